"""Grading as rows arrive: a stream of rows against a table of verdicts, each phrase looked up once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sanadflow.functions.profiles import VERDICT, Profile
from sanadflow.functions.text import query_phrase, word_set
from sanadflow.operators.match import graded


def first_deliveries(stream: DataFrame, keys: list[str], time: str, late: str = "40 days") -> DataFrame:
    """Rows of a stream without those delivered again within ``late``; the state is bounded by the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def grade_stream(stream: DataFrame, id_col: str, text: str, lookup: Callable[[DataFrame], DataFrame], cache: str, out: str, checkpoint: str, profile: Profile = VERDICT) -> StreamingQuery:
    """Appends ``id, label, match, score`` of every row of the stream to the table at ``out``.

    ``lookup`` turns a frame of ``phrase`` into candidates ``phrase, cand, ord, text``; it gets each
    phrase once, as what it found is kept in the table at ``cache`` and phrases held there
    (found or not) are left out. A batch that is run again overwrites its own files, so
    every row comes out exactly once.
    """
    spark = stream.sparkSession
    schema = "phrase string, cand string, ord long, text string"

    def held() -> DataFrame:
        return spark.read.schema(schema).option("ignoreMissingFiles", True).option("recursiveFileLookup", True).parquet(cache)

    def run(batch: DataFrame, number: int) -> None:
        rows = batch.select(F.col(id_col).cast("string").alias("id"), query_phrase(F.col(text)).alias("phrase"), word_set(F.col(text), profile).alias("tokens"))
        wanted = rows.select("phrase").distinct()
        earlier = held().where(~F.input_file_name().contains(f"/batch={number}/")) if number else None
        new = wanted.join(earlier.select("phrase").distinct(), "phrase", "left_anti") if number else wanted
        found = new.join(lookup(new), "phrase", "left").select("phrase", F.col("cand").cast("string"), F.col("ord").cast("long"), "text")
        found.write.mode("overwrite").parquet(f"{cache}/batch={number}")
        candidates = held().where("cand is not null").select("phrase", "cand", "ord", word_set(F.col("text"), profile).alias("tokens"))
        graded(rows, candidates).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
