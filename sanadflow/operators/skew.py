"""Per-key results when a few keys hold most rows (problem 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def heavy_hitters(df: DataFrame, key: str, share: float) -> DataFrame:
    """``key, total``: every key that may hold ``share`` of the rows with a key, and their number.

    One mergeable frequent-items sketch over the whole table, of a size given by ``share``
    alone. Its estimates are upper bounds, so no key at or above the share is missed; a few
    keys below it may be named, which costs nothing. At most ``4 / share`` rows.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    tracked = 1 << max(10, int(16 / share).bit_length())
    most = min(tracked, max(1, int(4 / share)))
    found = df.select(F.col(key).alias("key")).where("key is not null").agg(F.expr(f"approx_top_k(key, {most}, {tracked})").alias("top"), F.count("key").alias("total"))
    return found.select(F.explode("top").alias("top"), "total").where(F.col("top.count") >= F.floor(F.col("total") * share)).select(F.col("top.item").alias("key"), "total")


def _counts(facts: DataFrame, by: list[str]) -> DataFrame:
    return facts.groupBy(*by, "kind", "value").agg(F.sum("n").alias("n"))


def _labelled(name: str):
    return lambda x: F.struct(F.lit(name).alias("kind"), x.cast("string").alias("value"))


def key_profile(df: DataFrame, key: str, dimensions: dict[str, str], share: float = 0.005, salts: int = 16) -> DataFrame:
    """One row for each value of ``key``: ``key, n_rows, heavy``, and for each dimension
    ``n_{name}`` (distinct values) and ``{name}`` (``value=count`` in value order, joined by ``; ``).

    ``dimensions`` maps a result name to a column; values of an array column count one by one,
    nulls do not count. Heavy keys (:func:`heavy_hitters`) are split from the rest by a
    broadcast join with the sketch's bounded list and aggregated in two steps, first by key
    and salt; the rest is aggregated by an ordinary shuffle; both are then united.
    Every row is counted; nothing is sampled. A null key is a key of its own, as is ''.
    An empty table gives an empty result; other columns of ``df`` do not matter.
    """
    kinds = [F.struct(F.lit("").alias("kind"), F.lit(None).cast("string").alias("value"))]
    arrays = []
    for name, column in dimensions.items():
        if dict(df.dtypes)[column].startswith("array"):
            arrays.append(F.transform(F.coalesce(F.col(column), F.array()), _labelled(name)))
        else:
            kinds.append(F.struct(F.lit(name).alias("kind"), F.col(column).cast("string").alias("value")))
    facts = df.select(F.col(key).alias("key"), F.pmod(F.monotonically_increasing_id(), F.lit(salts)).alias("salt"), F.explode(F.concat(F.array(*kinds), *arrays)).alias("f"))
    facts = facts.select("key", "salt", "f.kind", "f.value", F.lit(1).alias("n")).where("kind = '' or value is not null")
    hot = F.broadcast(heavy_hitters(df, key, share).select("key"))
    heavy = _counts(_counts(facts.join(hot, "key"), ["key", "salt"]), ["key"]).withColumn("heavy", F.lit(True))
    rest = _counts(facts.join(hot, "key", "left_anti"), ["key"]).withColumn("heavy", F.lit(False))
    out = []
    for name in dimensions:
        held = F.array_sort(F.collect_list(F.when(F.col("kind") == name, F.struct("value", "n"))))
        out += [F.size(held).alias(f"n_{name}"), F.array_join(F.transform(held, lambda x: F.concat(x["value"], F.lit("="), x["n"].cast("string"))), "; ").alias(name)]
    rows = F.sum(F.when(F.col("kind") == "", F.col("n"))).alias("n_rows")
    return heavy.unionByName(rest).groupBy("key").agg(rows, F.max("heavy").alias("heavy"), *out).withColumnRenamed("key", key)


def heavy_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """``key, n_rows, total``: exactly the keys with at least ``share`` of the rows whose key is not null.

    The sketch names the candidates; their rows are counted exactly, through the broadcast
    side of the profile. Null is no key; blank keys are keys.
    """
    hot = F.broadcast(heavy_hitters(df, key, share))
    counted = df.select(F.col(key).alias("key")).join(hot, "key").groupBy("key", "total").agg(F.count("*").alias("n_rows"))
    return counted.where(F.col("n_rows") >= share * F.col("total")).select(F.col("key").alias(key), "n_rows", "total")
