"""python -m sanadflow: run queries, extract editions, grade rows, search, report people, build articles."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sanadflow", description=__doc__)
    sub = top.add_subparsers(dest="what", required=True)
    add = lambda name, text, *words: [sub.add_parser(name, help=text)] + [sub.choices[name].add_argument(w) for w in words]
    add("list", "names of all queries")
    add("run", "run a query over a folder of tables and write its rows", "query", "folder", "out")
    sub.choices["run"].add_argument("--format", default="parquet", choices=["parquet", "json", "csv", "orc"])
    add("archive", "authors and works in zip archives, by size", "path")
    sub.choices["archive"].add_argument("--grep")
    add("extract", "narrations of all works from a folder of edition files or zip archives, as one CSV a work, and a summary", "path", "lexicon", "out")
    sub.choices["extract"].add_argument("--works", help="CSV of fragment, title; the default list if not given")
    sub.choices["extract"].add_argument("--archives", action="store_true", help="path holds zip archives")
    add("grade", "best match of every row of a CSV among verdicts, from a table or the web", "rows", "out", "cache")
    for name, kind, default in (("--text-col", str, "arabic_text"), ("--start", int, 0), ("--limit", int, None), ("--verdicts", str, None), ("--base", str, None), ("--delay", float, 1.0)):
        sub.choices["grade"].add_argument(name, type=kind, default=default)
    sub.choices["grade"].epilog = "--verdicts is a table of phrase, cand, ord, text; without it, --base is the address asked with value=PHRASE"
    add("search", "answers of a web service, page by page", "url", "query", "out")
    sub.choices["search"].add_argument("--pages", type=int, default=3)
    sub.choices["search"].add_argument("--delay", type=float, default=1.0)
    sub.choices["search"].add_argument("--acceptable-only", action="store_true")
    add("people", "index of people of a dataset with biographies", "dataset", "biographies", "out")
    sub.choices["people"].add_argument("--min", type=int, default=3)
    sub.choices["people"].add_argument("--report", action="store_true")
    add("articles", "build articles against a dataset", "dataset", "folder", "out")
    sub.choices["articles"].add_argument("--check", action="store_true", help="check the references only")
    return top


def _extract(spark: SparkSession, a) -> None:
    from sanadflow.functions import defaults
    from sanadflow.plans.extract import extract
    from sanadflow.sources import collections, editions

    files = editions.read_archives(spark, a.path).where("raw is not null").select("path", "size", "raw") if a.archives else editions.read_editions(spark, a.path)
    works = collections.read_csv(spark, a.works, needs=("fragment", "title")) if a.works else defaults.works(spark)
    rows, summary = extract(files, works, defaults.read_lexicon(spark, a.lexicon))
    out = rows.select(F.col("title").alias("collection"), F.col("n").alias("seq_no"), F.lit("UNGRADED").alias("grade"), F.array_join("topics", "; ").alias("topics"), F.col("text").alias("arabic_text"), F.col("dups").alias("merged_dups"), F.col("title").alias("work"))
    out.repartition("work").write.partitionBy("work").option("header", True).option("escape", '"').mode("errorifexists").csv(f"{a.out}/rows")
    summary.withColumn("meta", F.to_json("meta")).coalesce(1).write.option("header", True).option("escape", '"').csv(f"{a.out}/summary")
    summary.show(100, truncate=False)


def _verdicts(spark: SparkSession, a):
    """The lookup of ``grade``: a table of verdicts by phrase, or pages of the web service."""
    from sanadflow.sources import web
    from sanadflow.sources.collections import read_verdicts

    if a.verdicts:
        return lambda phrases: spark.read.parquet(a.verdicts).join(phrases, "phrase")
    spark.dataSource.register(web.PagedJson)

    def ask(phrases: DataFrame) -> DataFrame:
        every = [r[0] for r in phrases.collect()]  # asked one by one, at the pace of the service
        answers = spark.read.format("paged_json").options(url=a.base, queries="\n".join(every), delay=str(a.delay)).load()
        found = read_verdicts(answers, "answer", "query")
        return found.select(F.col("query").alias("phrase"), F.col("grade").alias("cand"), F.monotonically_increasing_id().alias("ord"), "text")

    return ask


def _grade(spark: SparkSession, a) -> None:
    from sanadflow.plans.grading import grade_counts, grade_rows
    from sanadflow.sources.collections import read_csv

    rows = read_csv(spark, a.rows, needs=(a.text_col,)).withColumn("_id", F.monotonically_increasing_id())
    found = grade_rows(rows, "_id", a.text_col, _verdicts(spark, a), a.cache, a.start, a.limit)
    out = rows.join(found.select(F.col("id").cast("long").alias("_id"), "label", "match", "score"), "_id").orderBy("_id").drop("_id")
    out.write.option("header", True).option("escape", '"').csv(a.out)
    grade_counts(found).show(100, truncate=False)


def _search(spark: SparkSession, a) -> None:
    from sanadflow.operators.facets import grade_filter
    from sanadflow.sources import web
    from sanadflow.sources.collections import read_verdicts

    spark.dataSource.register(web.PagedJson)
    found = read_verdicts(spark.read.format("paged_json").options(url=a.url, queries=a.query, pages=str(a.pages), delay=str(a.delay)).load(), "answer")
    if a.acceptable_only:
        found = found.where(grade_filter(F.col("grade"), "hasan"))
    found.coalesce(1).write.option("header", True).option("escape", '"').csv(a.out)


def _people(spark: SparkSession, a) -> None:
    from sanadflow.operators import people
    from sanadflow.sources import collections

    rows = collections.read_dataset(spark, a.dataset)
    index = people.people_index(people.named(rows, "ord", "nr", "s", "t", "g"), people.biographies(collections.read_biographies(spark, a.biographies)), a.min)
    collections.write_json_document(index, a.out)
    if a.report:
        people.people_report(index, rows.count()).orderBy("part", "place").show(1000, truncate=False)


def _articles(spark: SparkSession, a) -> None:
    from sanadflow.functions import defaults
    from sanadflow.plans.articles import build_articles, publish_articles
    from sanadflow.sources import collections

    built = build_articles(collections.read_articles(spark, a.folder), collections.read_dataset(spark, a.dataset), defaults.collections(spark))
    print(*publish_articles(built, a.out, a.check), sep="\n")


def main(args: list[str] | None = None) -> None:
    top = _parser()
    given = top.parse_args(args)
    if given.what in ("grade", "search") and given.delay < 0.5:
        top.error("a delay below 0.5 seconds is too hard on the service")
    queries = importlib.import_module("__spark_entry__").queries() if given.what in ("list", "run") else {}
    if given.what == "list":
        print(*sorted(queries), sep="\n")
        return
    if given.what == "run" and given.query not in queries:
        top.error(f"no query {given.query}; see: python -m sanadflow list")
    spark = SparkSession.builder.appName("sanadflow").getOrCreate()
    if given.what == "run":
        queries[given.query](spark, given.folder).write.mode("errorifexists").format(given.format).save(given.out)
    elif given.what == "archive":
        from sanadflow.sources.editions import catalogue, read_archives

        catalogue(read_archives(spark, given.path).where("path is not null"), contains=given.grep).show(1000, truncate=False)
    else:
        {"extract": _extract, "grade": _grade, "search": _search, "people": _people, "articles": _articles}[given.what](spark, given)


if __name__ == "__main__":
    main()
