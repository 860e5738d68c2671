"""Collections, datasets and summaries: fixed schemas, readers and the file forms other tools expect."""

from __future__ import annotations

import csv
import json
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields of the files.
COLLECTION = "hadiths array<struct<ref_no:int,book:string,narrator:string,text:string,topics:array<string>,grade:string,also_at:array<string>,verify_phrase:string>>"
NARRATION = "s string, n int, b string, nr string, x string, t array<string>, g string, also array<string>, q string"
VERDICT = "text string, narrator string, scholar string, book string, number string, grade_ar string, grade string, explain string, takhrij string"
BIOGRAPHY = "scholar_indx string, name string, grade string, death_date_hijri string, death_date_gregorian string, birth_place string, death_place string"
ARTICLE = (
    "id string, title string, subtitle string, kicker string, readingTime string, summary string, sourceNote string, chapters array<struct<n:int,id:string,title:string,era:string,blurb:string,"
    "sections:array<struct<heading:string,paras:array<string>,hadith:array<struct<ref:array<string>,from:string,to:string>>>>>>"
)
UNGRADED = "No grading source"


def read_collections(spark: SparkSession, folder: str, slugs: Iterable[str]) -> DataFrame:
    """Records of ``{folder}/{slug}.json`` in the order of ``slugs``, as :data:`NARRATION` with ``ord``.

    A missing file is an error. ``also`` keeps the first three places; a missing grade is
    'No grading source', a missing phrase ''.
    """
    slugs = list(slugs)
    order = spark.createDataFrame(list(enumerate(slugs)), "place int, s string")
    docs = spark.read.schema(COLLECTION).option("multiLine", True).option("mode", "FAILFAST").json([f"{folder}/{s}.json" for s in slugs])
    docs = docs.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("s"), "hadiths").join(F.broadcast(order), "s")
    rows = docs.select("s", "place", F.posexplode("hadiths").alias("pos", "h"))
    fields = {"n": "ref_no", "b": "book", "nr": "narrator", "x": "text", "t": "topics"}
    named = [F.col(f"h.{old}").alias(new) for new, old in fields.items()]
    also = F.slice(F.coalesce("h.also_at", F.array().cast("array<string>")), 1, 3)
    ord_ = (F.col("place").cast("long") * 10**12 + F.col("pos")).alias("ord")
    return rows.select(ord_, "s", *named, F.coalesce("h.grade", F.lit(UNGRADED)).alias("g"), also.alias("also"), F.coalesce("h.verify_phrase", F.lit("")).alias("q"))


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A published dataset, one JSON array of :data:`NARRATION` records, with ``ord``, the place in the array."""
    kind = "array<struct<" + NARRATION.replace(", ", ",").replace(" ", ":").replace("array:", "array") + ">>"
    text = spark.read.option("wholetext", True).text(path)
    return text.select(F.posexplode(F.from_json("value", kind, {"mode": "FAILFAST"})).alias("ord", "r")).select(F.col("ord").cast("long").alias("ord"), "r.*")


def read_csv(spark: SparkSession, path: str, schema: str | None = None, needs: Iterable[str] = ()) -> DataFrame:
    """A CSV file with header, quoted fields over several lines and fields of any length.

    Raises ValueError naming the columns there are if one of ``needs`` is missing. A byte
    order mark is dropped. Without a schema all columns are strings.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("maxCharsPerColumn", -1)
    out = (reader.schema(schema) if schema else reader).csv(path)
    if missing := [c for c in needs if c not in out.columns]:
        raise ValueError(f"no column {', '.join(missing)} in {path}; there are {', '.join(out.columns)}")
    return out


def read_biographies(spark: SparkSession, path: str) -> DataFrame:
    """Biographies as :data:`BIOGRAPHY`, with ``ord``, their place in the file; ids and years stay text as delivered."""
    rows = read_csv(spark, path, needs=[f.split()[0] for f in BIOGRAPHY.split(", ")])
    return rows.select(*[f.split()[0] for f in BIOGRAPHY.split(", ")], F.monotonically_increasing_id().alias("ord"))


def read_articles(spark: SparkSession, folder: str, glob: str = "*.src.json") -> DataFrame:
    """The articles of a folder as :data:`ARTICLE`, with ``file``, the name of each without its ending; no file is an error."""
    docs = spark.read.schema(ARTICLE).option("multiLine", True).option("mode", "FAILFAST").option("pathGlobFilter", glob).json(folder)
    rows = docs.select(F.regexp_replace(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1), r"(\.src)?\.json$", "").alias("file"), "*")
    if rows.isEmpty():
        raise FileNotFoundError(f"no {glob} in {folder}")
    return rows.withColumn("id", F.coalesce("id", "file"))


def read_verdicts(texts: DataFrame, column: str, *keep: str) -> DataFrame:
    """Verdict records of JSON answers of any known shape: a list, or an object with the list as
    ``data``, ``data.hadiths`` or ``data.results``; fields under either of their names, '' for null.
    Records without a text, and answers of other shapes, give no row. Columns of ``keep`` come along."""
    row = "array<map<string,string>>"
    every = F.coalesce(*[F.from_json(F.get_json_object(column, p), row) for p in ("$.data.hadiths", "$.data.results", "$.data")], F.from_json(column, row))
    one = texts.select(*keep, F.explode(every).alias("m"))
    either = lambda *names: F.coalesce(*[F.nullif(F.col("m")[n], F.lit("")) for n in names], F.lit(""))
    fields = {"text": ("hadith", "text"), "narrator": ("rawi", "narrator"), "scholar": ("mohdith", "muhaddith"), "book": ("book", "source"), "number": ("numberOrPage", "number"), "grade_ar": ("grade", "degree"), "explain": ("explainGrade",), "takhrij": ("takhrij",)}
    return one.select(*keep, *[either(*names).alias(new) for new, names in fields.items()]).where("text <> ''")


def write_json_document(df: DataFrame, path: str, indent: int | None = None, most: int = 1_000_000) -> int:
    """All rows as one JSON array in one file, written when complete; compact unless ``indent``.

    For published files of bounded size: more than ``most`` rows are an error, and belong in
    ``df.write.json``. Rows come in the frame's order.
    """
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: write them with df.write.json")
    text = json.dumps([r.asDict(recursive=True) for r in rows], ensure_ascii=False, indent=indent, separators=None if indent else (",", ":"))
    with open(f"{path}.part", "w", encoding="utf-8") as f:
        f.write(text)
    os.replace(f"{path}.part", path)
    return len(rows)


def write_csv_document(df: DataFrame, path: str, most: int = 1_000_000) -> int:
    """All rows as one CSV file with a byte order mark and header; lists are joined by '; '. Bounded as above."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows: write them with df.write.csv")
    with open(f"{path}.part", "w", encoding="utf-8-sig", newline="") as f:
        out = csv.writer(f)
        out.writerow(df.columns)
        out.writerows([["; ".join(map(str, v)) if isinstance(v, list) else v for v in r] for r in rows])
    os.replace(f"{path}.part", path)
    return len(rows)
