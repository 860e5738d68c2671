"""References resolved against the dataset, quoted, and put back into their documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sanadflow.functions.text import excerpt


def resolve(refs: DataFrame, records: DataFrame, titles: DataFrame | None = None, must_start: str | None = "Sahih") -> DataFrame:
    """The columns of ``refs`` with ``text, src, book, grade, verify`` and ``error``.

    ``refs`` has ``slug, n`` and may have ``start, end`` for an excerpt; ``records`` has ``s, n, x, b,
    g, q, ord``: of records with equal ``s`` and ``n`` the last by ``ord`` counts. ``titles`` (``slug,
    title``) gives ``src``, else it is the slug. Errors: the reference is not in the dataset,
    its grade does not start with ``must_start`` (None: any), a marker of the excerpt does
    not occur. Every reference keeps its row.
    """
    last = F.row_number().over(Window.partitionBy("s", "n").orderBy(F.desc("ord")))
    one = records.withColumn("_r", last).where("_r = 1").select(F.col("s").alias("_s"), F.col("n").alias("_n"), "x", "b", "g", "q")
    out = refs.join(one, [refs["slug"] == F.col("_s"), refs["n"] == F.col("_n")], "left")
    for c in ("start", "end"):
        if c not in refs.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    where = F.concat(F.col("slug"), F.lit(" no."), refs["n"].cast("string"))
    out = out.withColumn("_e", excerpt(F.col("x"), F.col("start"), F.col("end")))
    error = F.when(F.col("_s").isNull(), F.concat(where, F.lit(" is not in the dataset")))
    if must_start is not None:
        error = error.when(~F.coalesce(F.col("g").startswith(must_start), F.lit(False)), F.concat(where, F.lit(' is graded "'), F.coalesce("g", F.lit("")), F.lit(f'", not {must_start}')))
    error = error.when(F.col("_e.error") == "start", F.concat(where, F.lit(' has no passage starting "'), F.col("start"), F.lit('"'))).when(F.col("_e.error") == "end", F.concat(where, F.lit(' has no passage ending "'), F.col("end"), F.lit('"')))
    out = out.withColumn("error", error)
    if titles is not None:
        out = out.join(titles.select(F.col("slug").alias("_t"), "title"), F.col("slug") == F.col("_t"), "left").withColumn("_src", F.coalesce("title", "slug"))
    else:
        out = out.withColumn("_src", F.col("slug"))
    ok = F.col("error").isNull()
    return out.select(*[refs[c] for c in refs.columns], F.when(ok, F.col("_e.text")).alias("text"), F.when(ok, F.col("_src")).alias("src"), F.when(ok, F.col("b")).alias("book"), F.when(ok, F.col("g")).alias("grade"), F.when(ok, F.coalesce("q", F.lit(""))).alias("verify"), "error")


def article_refs(articles: DataFrame) -> DataFrame:
    """``id, chapter, section, place, slug, n, start, end``: every quotation of every article, with its positions."""
    chapters = articles.select("id", F.posexplode("chapters").alias("chapter", "c"))
    sections = chapters.select("id", "chapter", F.posexplode("c.sections").alias("section", "s"))
    quotes = sections.select("id", "chapter", "section", F.posexplode("s.hadith").alias("place", "h"))
    return quotes.select("id", "chapter", "section", "place", F.col("h.ref")[0].alias("slug"), F.col("h.ref")[1].try_cast("int").alias("n"), F.col("h.from").alias("start"), F.col("h.to").alias("end"))


def manifest(articles: DataFrame) -> DataFrame:
    """``id, title, subtitle, kicker, summary, readingTime, chapters, sections, narrations`` of every article."""
    sections = F.flatten(F.transform("chapters", lambda c: F.coalesce(c["sections"], F.array().cast("array<struct<heading:string,paras:array<string>,hadith:array<struct<ref:array<string>,from:string,to:string>>>>"))))
    quotes = F.aggregate(sections, F.lit(0), lambda n, s: n + F.greatest(F.size(F.coalesce(s["hadith"], F.array().cast("array<struct<ref:array<string>,from:string,to:string>>"))), F.lit(0)))
    return articles.select("id", "title", "subtitle", "kicker", "summary", "readingTime", F.size("chapters").alias("chapters"), F.size(sections).alias("sections"), quotes.alias("narrations"))


def quotes_by_section(resolved: DataFrame) -> DataFrame:
    """``id, chapter, section, quotes``: resolved quotations back in order."""
    quote = F.struct("place", "text", "src", "slug", "n", "book", "grade", "verify")
    return resolved.where("error is null").groupBy("id", "chapter", "section").agg(F.array_sort(F.collect_list(quote)).alias("quotes"))
