"""Articles built from their sources: every quotation resolved, nothing published unless all of them are."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sanadflow.operators.facets import GateError
from sanadflow.operators.references import article_refs, manifest, quotes_by_section, resolve
from sanadflow.plans.layout import stored
from sanadflow.sources.collections import write_json_document

_SECTIONS = "array<struct<heading:string,paras:array<string>,hadith:array<struct<ref:array<string>,from:string,to:string>>>>"


@dataclass(frozen=True)
class Build:
    """``errors``: ``id, place, error`` of every quotation that does not resolve, ``place`` naming chapter and section;
    ``manifest``: a row for each article without errors, with the number of its quotations; ``documents``: these articles with what they quote in place."""

    errors: DataFrame
    manifest: DataFrame
    documents: DataFrame


def build_articles(articles: DataFrame, records: DataFrame, titles: DataFrame | None = None, must_start: str | None = "Sahih") -> Build:
    """Articles (see ``read_articles``) against the records of the dataset (``s, n, x, b, g, q, ord``).

    ``id`` must be unique. Articles without chapters, chapters without sections and sections without quotations stay as they are.
    """
    chapters = articles.select("id", F.posexplode("chapters").alias("chapter", "c"))
    sections = chapters.select("id", "chapter", F.col("c.n").alias("number"), F.col("c.title").alias("title"), F.posexplode("c.sections").alias("section", "s"))
    resolved = stored(resolve(article_refs(articles), records, titles, must_start))
    where = sections.select("id", "chapter", "section", F.concat(F.lit("ch"), F.coalesce(F.col("number").cast("string"), F.lit("")), F.lit(' "'), F.coalesce("title", F.lit("")), F.lit('" / '), F.substring(F.coalesce("s.heading", F.lit("")), 1, 28)).alias("place"))
    bad = resolved.where("error is not null").select("id", "chapter", "section", F.col("place").alias("_p"), "error")
    errors = bad.join(where, ["id", "chapter", "section"]).orderBy("id", "chapter", "section", "_p").select("id", "place", "error")
    good = articles.join(bad.select("id").distinct(), "id", "left_anti")
    quoted = sections.select("id", "chapter", "section", "s").join(quotes_by_section(resolved), ["id", "chapter", "section"], "left")
    whole = F.struct(F.col("s.heading").alias("heading"), F.col("s.paras").alias("paras"), F.coalesce("quotes", F.expr("slice(array(named_struct('place', 0, 'text', '', 'src', '', 'slug', '', 'n', 0, 'book', '', 'grade', '', 'verify', '')), 1, 0)")).alias("hadith"))
    by_chapter = quoted.groupBy("id", "chapter").agg(F.array_sort(F.collect_list(F.struct("section", whole.alias("s")))).alias("l")).select("id", "chapter", F.transform("l", lambda x: x["s"]).alias("sections"))
    rebuilt = chapters.join(by_chapter, ["id", "chapter"], "left").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("chapter", *[F.col(f"c.{f}").alias(f) for f in ("n", "id", "title", "era", "blurb")], "sections"))).alias("l"))
    keep = F.transform("l", lambda x: F.struct(*[x[f].alias(f) for f in ("n", "id", "title", "era", "blurb", "sections")]))
    documents = good.drop("chapters").join(rebuilt.select("id", keep.alias("chapters")), "id", "left")
    return Build(errors, manifest(good).orderBy("id"), documents)


def publish_articles(build: Build, out: str, check: bool = False, most: int = 10_000) -> list[str]:
    """Writes ``{out}/{id}.json`` for every article and ``{out}/manifest.json``, and returns the ids.

    Raises :class:`GateError` with all errors before anything is written if there is one; with ``check`` nothing is written at all.
    """
    errors = build.errors.limit(most).collect()
    if errors:
        raise GateError(f"{len(errors)} references do not resolve:\n" + "\n".join(f"{r['id']}: {r['place']}: {r['error']}" for r in errors))
    entries = build.manifest.limit(most + 1).collect()
    if len(entries) > most:
        raise ValueError(f"more than {most} articles")
    if not check:
        for r in entries:
            write_json_document(build.documents.where(F.col("id") == r["id"]), f"{out}/{r['id']}.json", indent=1)
        write_json_document(build.manifest, f"{out}/manifest.json", indent=1)
    return [r["id"] for r in entries]
