"""Marked-up text editions: archive catalogue, header, entries in either dialect, best edition."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sanadflow.functions.text import collapse

# Header marks of the edition format; endings of files that are no editions.
META = "#META#"
HEADER_END = "#META#Header#End#"
#: What counts as one space within a line: page marks and signs of a broken line; and with white space of any kind.
_MARK = r"\b(?:PageV\p{Nd}+P\p{Nd}+|ms\p{Nd}+)\b|~~"
_BLANK = rf"(?:[\s\x{{85}}\p{{IsWhite_Space}}&&[^\n]]|{_MARK})"
NOT_EDITIONS = ("/", ".yml", ".md", ".completed", ".inprogress")


def read_editions(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, size, raw`` of every file under ``path``; bad bytes are replaced."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("content").cast("string").alias("raw"))


def catalogue(members: DataFrame, path: str = "path", size: str = "size", contains: str | None = None) -> DataFrame:
    """``author, work, size`` of an archive's listing, largest first: members deep enough to be
    texts, their sizes added up. ``contains`` filters either name, whatever the case."""
    parts = F.split(path, "/")
    rows = members.where(F.size(parts) > 4).where(~F.col(path).rlike(r"(/|\.yml|\.md)$")).select(parts[2].alias("author"), parts[3].alias("work"), F.col(size).alias("size"))
    out = rows.groupBy("author", "work").agg(F.sum("size").alias("size"))
    if contains is not None:
        out = out.where(F.lower("author").contains(contains.lower()) | F.lower("work").contains(contains.lower()))
    return out.orderBy(F.desc("size"), "author", "work")


def is_edition(path: Column, fragment: Column) -> Column:
    """The path holds the fragment and the author before its dot, and does not end like a side file."""
    low = F.lower(path)
    author = F.split(F.lower(fragment), r"\.")[0]
    return low.contains(F.lower(fragment)) & low.contains(author) & ~low.rlike("(" + "|".join(x.replace(".", r"\.") for x in NOT_EDITIONS) + ")$")


def header(raw: Column) -> Column:
    """Fields of the header as a map; the last of equal keys counts."""
    head = F.split(raw, HEADER_END)[0]
    lines = F.filter(F.split(head, "\n"), lambda x: x.startswith(META) & x.contains("::"))
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.regexp_replace(F.regexp_extract(x, "^(.*?)::", 1), META, "")).alias("key"), F.trim(F.regexp_extract(x, "::(.*)$", 1)).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def body(raw: Column) -> Column:
    """The text after the last header end; all of it if there is none."""
    return F.substring_index(raw, HEADER_END, -1)


def entries(editions: DataFrame, edition: str = "path", raw: str = "raw", least_words: int = 6) -> DataFrame:
    """``edition, dialect, ord, n, text``: the entries of every edition, in the dialect that gives more.

    In the numbered dialect ``# N text`` opens an entry, a section mark closes it, and lines
    after a section mark belong to none; in the section dialect every ``###`` opens one, with
    what follows on its line. More entries decide, before short ones (fewer than
    ``least_words`` words) are left out; equal numbers mean numbered. ``n`` is the printed
    number, or the position among sections; ``ord`` is the position and unique. Null texts
    have no entry. Lines are put together within an edition only.
    """
    rows = editions.select(F.col(edition).alias("edition"), F.col(raw).alias("raw")).where("raw is not null")
    # An edition is one row, which is cut where its entries begin: nothing is moved, and large texts are not copied more often than that takes.
    opens, closes = rf"#{_BLANK}*\p{{Nd}}+{_BLANK}+", rf"#+(?:[ \t\x0B\f\r]|{_MARK})*\||###"
    rest = lambda x: F.regexp_replace(x, rf"^#+{_BLANK}*\|*{_BLANK}*", "")
    rows = rows.select("edition", body(F.col("raw")).alias("text"))
    sections = F.regexp_count("text", F.lit(r"(?:^|\n)###")) - F.regexp_count("text", F.lit(rf"(?:^|\n)###+{_BLANK}*\|*{_BLANK}*(?=\n###|\z)")) + F.when(F.col("text").startswith("###"), 0).otherwise(1)
    by_number = F.regexp_count("text", F.lit(rf"(?:^|\n){opens}")) >= sections
    rows = rows.select("edition", "text", F.when(by_number, "numbered").otherwise("section").alias("dialect"))
    cut = F.when(F.col("dialect") == "numbered", F.split("text", rf"\n(?={opens}|{closes})")).otherwise(F.split("text", r"\n(?=###)"))
    held = lambda x: F.when(F.col("dialect") == "numbered", x.rlike(f"^{opens}")).otherwise(~x.startswith("###") | F.contains(x, F.lit("\n")) | (rest(x) != ""))
    rows = rows.select("edition", "dialect", F.filter(cut, held).alias("found"))
    found = rows.select("edition", "dialect", F.posexplode("found").alias("pos", "text")).withColumn("ord", (F.col("pos") + 1).cast("int"))
    digits = F.translate(F.regexp_extract("text", rf"^#{_BLANK}*(\p{{Nd}}+)", 1), "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "01234567890123456789")
    n = F.when(F.col("dialect") == "numbered", digits.try_cast("int"))
    piece = F.when(F.col("dialect") == "numbered", F.regexp_replace("text", f"^{opens}", "")).when(F.col("text").startswith("###"), rest(F.col("text"))).otherwise(F.col("text"))
    text = collapse(F.regexp_replace(F.regexp_replace(piece, _MARK.removesuffix("|~~"), " "), "~~", " "))
    out = found.select("edition", "dialect", "ord", F.coalesce(n, F.col("ord")).cast("int").alias("n"), text.alias("text"))
    return out.where(F.size(F.split("text", " ")) >= least_words)


def best_edition(editions: DataFrame, work: str = "work", path: str = "path", size: str = "size", raw: str = "raw", tried: int = 6) -> DataFrame:
    """``work, path, n_entries``: of the ``tried`` largest files of each work the one with most
    entries, equal ones by size. Files of null text have no entry; a work of such files only is left out."""
    rank = F.row_number().over(Window.partitionBy(work).orderBy(F.desc(size), path))
    largest = editions.select(work, path, size).withColumn("_r", rank).where(F.col("_r") <= tried).drop("_r")
    # At most ``tried`` paths of each work are sent to where the texts lie; these stay.
    counts = entries(editions.join(F.broadcast(largest.select(work, path)), [work, path], "left_semi"), path, raw).groupBy(F.col("edition").alias(path)).agg(F.count("*").alias("n_entries"))
    best = F.row_number().over(Window.partitionBy(work).orderBy(F.desc("n_entries"), F.desc(size), path))
    return largest.select(work, path, size).join(counts, path).withColumn("_r", best).where("_r = 1").select(work, path, "n_entries")


def _members(contains: str | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for m in z.infolist():
                            if not m.is_dir() and (contains is None or contains.lower() in m.filename.lower()):
                                try:
                                    raw, error = z.read(m).decode("utf-8", errors="replace"), None
                                except (zipfile.BadZipFile, NotImplementedError, RuntimeError, zlib.error) as e:
                                    raw, error = None, f"{type(e).__name__}: {e}"
                                yield pd.DataFrame({"archive": [archive], "path": [m.filename], "size": [m.file_size], "raw": [raw], "error": [error]}, dtype=object)
                except zipfile.BadZipFile as e:
                    yield pd.DataFrame({"archive": [archive], "path": [None], "size": [None], "raw": [None], "error": [f"BadZipFile: {e}"]}, dtype=object)

    return run


def read_archives(spark: SparkSession, path: str, contains: str | None = None) -> DataFrame:
    """``archive, path, size, raw, error``: the members of all zip archives under ``path``, one row each,
    as text with bad bytes replaced; ``contains`` keeps members whose path holds it, whatever the
    case. What cannot be read is a row with ``error`` and no text, and does not stop the others."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(path)
    return files.select("path", "content").mapInPandas(_members(contains), "archive string, path string, size long, raw string, error string")
