"""Queries of problem 1: narrators that hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sanadflow.operators.skew import key_profile
from sanadflow.sources.tables import table

SHARE = 0.02


def p1_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, collections, grades and topics of every value of ``nr``."""
    return _profile(table(spark, folder, "hadith")).drop("heavy")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The values that hold at least a fiftieth of the named rows, out of the profile of all values."""
    rows = table(spark, folder, "hadith")
    total = rows.agg(F.count("nr").alias("total"))
    held = _profile(rows).where("heavy").join(F.broadcast(total)).where(F.col("n_rows") >= SHARE * F.col("total"))
    return held.where(F.col("nr").rlike(r"(?U)\S")).select("nr")


def _profile(rows: DataFrame) -> DataFrame:
    return key_profile(rows, "nr", {"collections": "s", "grades": "g", "topics": "t"}, SHARE / 2)


_PART = "(SELECT nr, count(*) AS k, string_agg(v || '=' || c, '; ' ORDER BY v) AS j FROM (SELECT nr, {v} AS v, count(*) AS c FROM {t} GROUP BY 1, 2) WHERE v IS NOT NULL GROUP BY 1)"

QUERIES = {"p1_profile": p1_profile, "p1_found": p1_found}
SQL = {
    "p1_profile": f"""
SELECT r.nr, r.n_rows, coalesce(s.k, 0)::INT AS n_collections, coalesce(s.j, '') AS collections, coalesce(g.k, 0)::INT AS n_grades, coalesce(g.j, '') AS grades,
       coalesce(t.k, 0)::INT AS n_topics, coalesce(t.j, '') AS topics
FROM (SELECT nr, count(*) AS n_rows FROM hadith GROUP BY 1) r
LEFT JOIN {_PART.format(v="s", t="hadith")} s ON s.nr IS NOT DISTINCT FROM r.nr
LEFT JOIN {_PART.format(v="g", t="hadith")} g ON g.nr IS NOT DISTINCT FROM r.nr
LEFT JOIN {_PART.format(v="v", t="(SELECT nr, unnest(t) AS v FROM hadith)")} t ON t.nr IS NOT DISTINCT FROM r.nr""",
    "p1_found": "SELECT nr FROM hadith WHERE nr IS NOT NULL AND regexp_matches(nr, '\\S') GROUP BY nr HAVING count(*) >= 0.02 * (SELECT count(nr) FROM hadith)",
}
