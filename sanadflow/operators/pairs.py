"""Pairs of classes to pairs of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 8


def expand_pairs(links: DataFrame, members: DataFrame, key: list[str], salts: int = SALTS) -> DataFrame:
    """Pairs of ids ``a < b`` from links between classes.

    ``links`` has ``{k}_a`` and ``{k}_b`` for each ``k`` of ``key`` (a link of a class
    with itself gives the pairs inside it); ``members`` has ``key`` and ``id``. Every
    link must stand once, in either direction. The joins are equi-joins in which the
    links are spread over ``salts`` parts of each class, so a class with very many
    members is worked on by several tasks; what comes out is exactly the result.
    Ids must be unique in ``members``.
    """
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")
    left = members.select(*[F.col(k).alias(f"{k}_a") for k in key], F.col("id").alias("_x"), salt.alias("_s"))
    right = members.select(*[F.col(k).alias(f"{k}_b") for k in key], F.col("id").alias("_y"), salt.alias("_r"))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    one = links.withColumn("_s", every).join(left, [*(f"{k}_a" for k in key), "_s"]).drop("_s")
    both = one.withColumn("_r", every).join(right, [*(f"{k}_b" for k in key), "_r"])
    same = F.lit(True)
    for k in key:
        same &= F.col(f"{k}_a") == F.col(f"{k}_b")
    return both.where(~same & (F.col("_x") != F.col("_y")) | same & (F.col("_x") < F.col("_y"))).select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"))
