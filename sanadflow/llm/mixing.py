"""Mixing sources to target weights (problem 8): Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

import heapq
import math
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sanadflow.llm.words import pieces
from sanadflow.plans.layout import spread, stored


@dataclass(frozen=True)
class Mixture:
    """Parameters: tokens of the mixture (None: as many as let every source reach its share within
    its repeats), tokens of a block, most tokens of a shard, seed of the selection, and tokenizer
    file (where a machine lacks the path, the file is taken from those shipped with the job)."""

    tokens: int | None = None
    block: int = 128
    shard: int = 1 << 27
    seed: int = 11
    tokenizer: str = "/opt/tokenizers/byte_bpe_50k.json"


@lru_cache(2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))
    found.encode_special_tokens = True
    return found


def count_tokens(path: str):
    """mapInArrow function: ``id, source, tokens`` of ``id, source, text``; null text has none. Equal texts of a batch are counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for whole in batches:
            for at, many in pieces(whole.column("text"), rows=256):
                batch = whole.slice(at, many)
                texts = batch.column("text").fill_null("").dictionary_encode()
                sizes = np.array([len(x.ids) for x in tokenizer.encode_batch_fast(texts.dictionary.to_pylist(), add_special_tokens=False)], np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("source"), pa.array(sizes[np.asarray(texts.indices)])], names=["id", "source", "tokens"])

    return run


def sainte_lague(weights: list[float], caps: list[int], seats: int) -> list[int]:
    """Seats for each weight by the highest quotients ``weight / (2 * held + 1)``, none above its cap.

    Found through the divisor at which the rounded weights add up, so the work does not grow
    with the seats; the last few seats go by quotient, ties to the earlier weight. Where the
    caps hold fewer seats than asked, all caps are filled (weights of 0 get none).
    """
    caps = [c if w > 0 else 0 for w, c in zip(weights, caps, strict=True)]
    seats = min(seats, sum(caps))
    if not seats:
        return [0] * len(weights)
    # Seats held when every quotient above t has been served: as many k as have weight / (2k + 1) > t.
    held = lambda t: [min(c, max(0, math.ceil((w / t - 1) / 2))) for w, c in zip(weights, caps, strict=True)]
    low, high = min(w for w in weights if w > 0) / (4 * seats + 4), 2 * max(weights)
    while sum(held(low)) < seats and low > 1e-300:
        low /= 2
        if held(low) == caps:
            break
    for _ in range(200):
        middle = (low + high) / 2
        if sum(held(middle)) <= seats:
            high = middle
        else:
            low = middle
    # The last seats one by one, in the order of their quotients: rounding may have moved one across the divisor.
    out = [max(0, x - 1) for x in held(high)]
    heap = [(-w / (2 * x + 1), i) for i, (w, x, c) in enumerate(zip(weights, out, caps, strict=True)) if x < c]
    heapq.heapify(heap)
    for _ in range(seats - sum(out)):
        _, i = heapq.heappop(heap)
        out[i] += 1
        if out[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * out[i] + 1), i))
    return out


def mix(docs: DataFrame, doc_id: str, text: str, source: str, targets: DataFrame, p: Mixture = Mixture()) -> tuple[DataFrame, DataFrame]:
    """The mixture, ``doc_id, source, tokens, copies``, and its report by source.

    ``targets`` has ``source, target_share, max_repeats``, one row for each source. The mixture is
    apportioned to the sources in blocks of equal tokens by Sainte-Lague, within what each source
    holds ``max_repeats`` times, and a source's blocks to its shards likewise. Each shard is laid
    out in seeded order and cut into blocks; it gives all of it as often as its quota holds it,
    and once more as much as is left, block by block in another seeded order. Documents stay
    whole: a document belongs to the block in which it starts, and of the last block chosen those
    documents are taken that bring the shard nearest to its quota, so a quota is missed by half a
    document at most. No document stands in the mixture more than ``max_repeats`` times; what a
    capped source cannot give goes to the others.

    Without ``p.tokens`` the mixture is the largest in which every source that holds documents
    reaches its share: the source with the least tokens for its share, times its repeats, sets it.
    Documents of null or other sources, and those without a token, are not in the mixture; a
    target without documents is in the report with 0, its share going to the others. Report: ``source,
    target_share, max_repeats, documents, tokens, capped, mixed_tokens, mixed_documents, actual_share``;
    ``capped`` says that the source gives all it may. Shares need not sum to 1.
    """
    spark = docs.sparkSession
    wanted = targets.select(F.col("source").cast("string"), F.col("target_share").cast("double"), F.col("max_repeats").cast("int")).where("source is not null")
    kind = docs.schema[doc_id].dataType.simpleString()
    if not spark.sparkContext.master.startswith("local["):
        spark.sparkContext.addFile(p.tokenizer)
    rows = spread(docs.select(F.col(doc_id).alias("id"), F.col(source).alias("source"), F.col(text).alias("text")))
    rows = rows.join(wanted.select("source"), "source", "left_semi").select("id", "source", "text")
    counted = rows.mapInArrow(count_tokens(p.tokenizer), f"id {kind}, source string, tokens long").where("tokens > 0")
    counted = stored(counted)

    held = counted.groupBy("source").agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"))
    shards = held.select("source", F.ceil(F.col("tokens") / p.shard).alias("shards"))
    placed = counted.join(shards, "source").withColumn("shard", F.pmod(F.xxhash64(F.lit(p.seed + 1), "id"), "shards"))
    in_order = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(p.seed), "id"), "id")
    before = F.coalesce(F.sum("tokens").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = stored(placed.select("id", "source", "shard", "tokens", F.floor(before / p.block).alias("block"), before.alias("start")))

    # One row for each 2^27 tokens of each source.
    sizes = placed.groupBy("source", "shard").agg(F.sum("tokens").alias("tokens")).join(wanted, "source").orderBy("source", "shard").collect()
    quota = spark.createDataFrame(_quotas(sizes, p), "source string, shard long, times long, more long, capped boolean")
    # The blocks' seeded order, and in it the documents of the one more pass: those whose middle lies within the rest of the quota.
    again = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(p.seed + 2), "block"), "block", "start")
    middle = F.coalesce(F.sum("tokens").over(again.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("tokens") / 2
    chosen = placed.join(quota, ["source", "shard"]).withColumn("copies", F.col("times") + (middle <= F.col("more")).cast("long"))
    mixed = stored(chosen.where("copies > 0").select(F.col("id").alias(doc_id), "source", "tokens", "copies"))

    took = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), F.sum("copies").alias("mixed_documents"))
    capped = quota.groupBy("source").agg(F.max("capped").alias("capped"))
    report = wanted.join(held, "source", "left").join(capped, "source", "left").join(took, "source", "left").na.fill(0, ["documents", "tokens", "mixed_tokens", "mixed_documents"]).na.fill(False, ["capped"])
    total = took.agg(F.sum("mixed_tokens").alias("_all"))
    report = report.join(F.broadcast(total)).withColumn("actual_share", F.coalesce(F.col("mixed_tokens") / F.col("_all"), F.lit(0.0))).drop("_all")
    return mixed, report


def _quotas(sizes, p: Mixture) -> list[tuple[str, int, int, int, bool]]:
    """For each shard: how often all of it is taken, how many tokens are taken once more, and whether its source gives all it may."""
    by: dict[str, list] = {}
    for r in sizes:
        by.setdefault(r["source"], []).append(r)
    names = list(by)
    weights = [max(by[s][0]["target_share"] or 0.0, 0.0) for s in names]
    limits = [sum(r["tokens"] for r in by[s]) * max(by[s][0]["max_repeats"] or 0, 0) for s in names]
    total = p.tokens
    if total is None:
        total = min((c / w for w, c in zip(weights, limits, strict=True) if w > 0), default=0.0) * sum(weights)
    seats = sainte_lague(weights, [math.ceil(c / p.block) for c in limits], round(total / p.block))
    out = []
    for s, seat, limit in zip(names, seats, limits, strict=True):
        own = by[s]
        repeats = max(own[0]["max_repeats"] or 0, 0)
        share = sainte_lague([float(x["tokens"]) for x in own], [math.ceil(x["tokens"] * repeats / p.block) for x in own], seat)
        for x, n in zip(own, share, strict=True):
            tokens = min(n * p.block, x["tokens"] * repeats)
            out.append((s, x["shard"], tokens // x["tokens"], tokens % x["tokens"], 0 < limit < (seat + 1) * p.block))
    return out
