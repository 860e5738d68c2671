"""Search and browsing: filters, facet counts, pages, and the gates a published set must pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What stands for no grade; grade filters of the browser and the grades they let through.
NO_GRADE = ("No grading source", "Ungraded", "UNGRADED", "")
GRADES = {"all": None, "sahih": "^Sahih", "hasan": "^(Sahih|Hasan)", "weak": "Da'if|^Mawdu"}


def grade_filter(grade: Column, level: str) -> Column:
    """'all', 'sahih', 'hasan' (and better) or 'weak'; a null grade passes 'all' only, so what is ungraded is never taken for sound."""
    pattern = GRADES[level]
    return F.lit(True) if pattern is None else F.coalesce(grade.rlike(pattern), F.lit(False))


def contains_text(query: str, *columns: str) -> Column:
    """The query, whatever its case, in any of the columns; arrays are searched by element."""
    low = query.lower()
    return F.lower(F.concat_ws("\n", *columns)).contains(low)


def search_articles(articles: DataFrame, query: str) -> DataFrame:
    """Articles whose title, subtitle, summary, headings or paragraphs hold the query, whatever its case."""
    sections = F.flatten(F.transform("chapters", lambda c: F.coalesce(c["sections"], F.array())))
    inside = F.array_join(F.transform(sections, lambda s: F.concat_ws("\n", s["heading"], s["paras"])), "\n")
    titles = F.array_join(F.transform("chapters", lambda c: F.concat_ws("\n", c["title"], c["blurb"])), "\n")
    whole = F.concat_ws("\n", "title", "subtitle", "kicker", "summary", titles, inside)
    return articles.where(F.lower(whole).contains(query.lower()))


def search_people(index: DataFrame, query: str) -> DataFrame:
    """People whose name, other script's name or any spelling holds the query, whatever its case."""
    return index.where(contains_text(query, "name", "ar", "variants", "raw"))


def tier_filter(grade: Column, tier: str) -> Column:
    """'both', 'graded' or 'ungraded': whether any grade is on record."""
    known = F.coalesce(~grade.isin(*NO_GRADE), F.lit(False))
    return {"both": F.lit(True), "graded": known, "ungraded": ~known}[tier]


def facet_filter(df: DataFrame, topic: str | None = None, collections: list[str] | None = None, grade: str = "all", query: str | None = None, tier: str = "both") -> DataFrame:
    """Rows of the record form (``s, b, nr, x, t, g``) that pass every filter given."""
    keep = grade_filter(F.col("g"), grade) & tier_filter(F.col("g"), tier)
    if topic is not None:
        keep &= F.coalesce(F.array_contains("t", topic), F.lit(False))
    if collections is not None:
        keep &= F.col("s").isin(*collections)
    if query is not None:
        keep &= contains_text(query, "x", "nr", "b", "t")
    return df.where(keep)


def page(df: DataFrame, number: int, size: int = 25, order: str = "ord") -> DataFrame:
    """One page, from 0, in the order of a unique column."""
    return df.orderBy(order).offset(number * size).limit(size)


def rows_from(df: DataFrame, start: int = 0, limit: int | None = None, order: str = "ord") -> DataFrame:
    """``limit`` rows from ``start`` on; None is all of them, 0 none."""
    out = df.orderBy(order).offset(start)
    return out if limit is None else out.limit(limit)


def facet_counts(df: DataFrame) -> DataFrame:
    """``facet, value, n``: rows by topic, collection and grade in one pass; null values are counted as null."""
    facts = F.concat(F.array(*[F.struct(F.lit(f).alias("facet"), F.col(c).cast("string").alias("value")) for f, c in (("collection", "s"), ("grade", "g"))]), F.transform(F.array_distinct(F.coalesce("t", F.array().cast("array<string>"))), lambda x: F.struct(F.lit("topic").alias("facet"), x.alias("value"))))
    return df.select(F.explode(facts).alias("f")).groupBy("f.facet", "f.value").agg(F.count("*").alias("n"))


def topic_shares(df: DataFrame, most: float = 0.15) -> DataFrame:
    """``topic, n, share, over``: rows of each topic, their share of all rows, and whether it is over the limit."""
    total = df.agg(F.count("*").alias("_all"))
    each = df.select(F.explode(F.array_distinct("t")).alias("topic")).groupBy("topic").agg(F.count("*").alias("n"))
    return each.join(F.broadcast(total)).select("topic", "n", (F.col("n") / F.col("_all")).alias("share"), (F.col("n") / F.col("_all") > most).alias("over"))


class GateError(AssertionError):
    """What a published set must fulfil does not hold."""


def gate(df: DataFrame, bad: Column, what: str, show: int = 5) -> DataFrame:
    """``df`` unchanged if no row is ``bad`` (null is not); else :class:`GateError` with the number and some rows."""
    found = df.where(bad)
    n = found.count()
    if n:
        raise GateError(f"{what}: {n} rows, such as {[r.asDict() for r in found.take(show)]}")
    return df


def is_weak(grade: Column) -> Column:
    return F.coalesce(grade.contains("Da'if") | grade.startswith("Mawdu"), F.lit(False))


def expectations(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """``name, value, expected, tolerance, ok`` of named figures against ``name, expected, tolerance``
    (relative); a figure that is missing is not ok."""
    out = expected.join(actual, "name", "left")
    return out.select("name", "value", "expected", "tolerance", F.coalesce(F.abs(F.col("value") - F.col("expected")) <= F.col("tolerance") * F.abs("expected"), F.lit(False)).alias("ok"))
