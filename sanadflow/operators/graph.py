"""Connected components of an undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sanadflow.plans.layout import cut


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``links``; a component's id is its least node.

    Each round contracts the graph: every node goes to the neighbour of the least hash, if
    that is less than its own, and from there one step further; links inside a contracted
    node vanish. Hashes change from round to round, so also long chains shrink by a constant
    factor. The links left, and each round's relabelling, are checkpointed: a lost executor
    costs one round. Null ends are ignored, loops give single nodes; an empty table gives an
    empty result.
    """
    edges = cut(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null").distinct())
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    edges = edges.where("a <> b")
    for number in range(rounds):
        if edges.isEmpty():
            least = labels.groupBy("label").agg(F.min("node").alias("component"))
            return cut(labels.join(least, "label").select("node", "component"))
        by_hash = lambda c: F.struct(F.xxhash64(F.lit(number), c).alias("h"), F.col(c).alias("v"))  # noqa: B023, E731
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")
        first = both.groupBy(F.col("a").alias("old")).agg(F.min(by_hash("b")).alias("m")).select("old", F.least(by_hash("old"), "m")["v"].alias("new"))
        onward = first.select(F.col("old").alias("new"), F.col("new").alias("end"))
        step = cut(first.join(onward, "new").select("old", F.col("end").alias("new")))
        labels = labels.join(step.withColumnRenamed("old", "label"), "label", "left").select("node", F.coalesce("new", "label").alias("label"))
        if number % 4 == 3:
            labels = cut(labels)
        edges = edges.join(step.select(F.col("old").alias("a"), F.col("new").alias("x")), "a").join(step.select(F.col("old").alias("b"), F.col("new").alias("y")), "b")
        edges = cut(edges.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    raise RuntimeError(f"components: not settled after {rounds} rounds")
