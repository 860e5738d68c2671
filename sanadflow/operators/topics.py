"""Keyword classification with several topics for a record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_TOPIC = "Other Narrations"
PREFIX = 5


def topic_scores(sets: DataFrame, lexicon: DataFrame, key: str = "ord") -> DataFrame:
    """``key, topic, topic_ord, score``: two for each keyword among the words, one for each keyword
    that shares its first five letters with another word.

    ``sets`` has ``tokens``; ``lexicon`` has ``topic, topic_ord, keyword`` and is fixed in size, so
    it is broadcast where Spark finds it small. Repeated keywords of a topic count once.
    """
    entries = lexicon.select("topic", "topic_ord", "keyword").where("keyword is not null").distinct()
    words = sets.select(F.col(key), F.explode("tokens").alias("token"))
    exact = words.join(entries, words["token"] == entries["keyword"]).select(key, "topic", "topic_ord", "keyword", F.lit(2).alias("points"))
    start = lambda c: F.when(F.length(c) >= PREFIX, F.substring(c, 1, PREFIX))
    by_start = entries.withColumn("_p", start("keyword"))
    near = words.withColumn("_q", start("token")).join(by_start, F.col("_q") == F.col("_p")).where("token <> keyword").select(key, "topic", "topic_ord", "keyword", F.lit(1).alias("points"))
    return exact.unionAll(near.distinct()).groupBy(key, "topic", "topic_ord").agg(F.sum("points").alias("score"))


def assign_topics(sets: DataFrame, lexicon: DataFrame, key: str = "ord", strong: int = 4, most: int = 4) -> DataFrame:
    """``key, topics``: up to four topics of a score of four or more; else the best two of two or more;
    else the best one; else 'Other Narrations'. Equal scores go by the lexicon's order."""
    scored = topic_scores(sets, lexicon, key)
    ranked = scored.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("topic_ord").alias("o"), F.col("topic").alias("t")))).alias("r"))
    take = lambda least, n: F.slice(F.filter("r", lambda x: x["s"] <= -least), 1, n)
    chosen = F.when(F.size(take(strong, most)) > 0, take(strong, most)).when(F.size(take(2, 2)) > 0, take(2, 2)).otherwise(F.slice("r", 1, 1))
    names = ranked.select(key, F.transform(chosen, lambda x: x["t"]).alias("topics"))
    return sets.select(key).join(names, key, "left").select(key, F.coalesce("topics", F.array(F.lit(NO_TOPIC))).alias("topics"))


def lint_lexicon(lexicon: DataFrame, normal, shortest: int = 3) -> DataFrame:
    """``topic, keyword, reason``: keywords that can never match a word, being too short or not in the form of words."""
    reason = F.when(F.length("keyword") < shortest, "too short").when(normal(F.col("keyword")) != F.col("keyword"), "not in normal form")
    return lexicon.select("topic", "keyword", reason.alias("reason")).where("reason is not null")
