"""Grading of rows in a batch, with a table of phrases that lasts from run to run."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sanadflow.functions.profiles import VERDICT, Profile
from sanadflow.functions.text import query_phrase, word_set
from sanadflow.operators.facets import rows_from
from sanadflow.operators.match import graded

CACHE = "phrase string, cand string, ord long, text string"


def phrase_cache(spark: SparkSession, path: str) -> DataFrame:
    """The table of phrases asked before; empty if there is none yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(CACHE).option("recursiveFileLookup", True).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], CACHE)


def grade_rows(rows: DataFrame, id_col: str, text: str, lookup: Callable[[DataFrame], DataFrame], cache: str, start: int = 0, limit: int | None = None, profile: Profile = VERDICT) -> DataFrame:
    """``id, label, match, score`` of the rows from ``start`` on in the order of ``id_col``, ``limit`` of them or all.

    ``lookup`` turns a frame of ``phrase`` into candidates ``phrase, cand, ord, text``. It gets every phrase once: what it finds,
    or that it found nothing, is added to the table at ``cache``, and phrases there are not asked again. A run that
    fails before its phrases are written asks them again; none is lost or doubled.
    """
    spark = rows.sparkSession
    chosen = rows.select(F.col(id_col), F.col(text))
    if start or limit is not None:
        chosen = rows_from(chosen, start, limit, id_col)
    asked = chosen.select(F.col(id_col).cast("string").alias("id"), query_phrase(F.col(text)).alias("phrase"), word_set(F.col(text), profile).alias("tokens"))
    held = phrase_cache(spark, cache)
    new = asked.where("phrase <> ''").select("phrase").distinct().join(held.select("phrase").distinct(), "phrase", "left_anti")
    found = new.join(lookup(new), "phrase", "left").select("phrase", F.col("cand").cast("string"), F.col("ord").cast("long"), "text")
    found.write.parquet(f"{cache}/run={uuid.uuid4().hex}")
    candidates = phrase_cache(spark, cache).where("cand is not null").select("phrase", "cand", "ord", word_set(F.col("text"), profile).alias("tokens"))
    return graded(asked, candidates)


def grade_counts(rows: DataFrame, column: str = "label") -> DataFrame:
    """``value, n``: rows of each value, most frequent first."""
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")
