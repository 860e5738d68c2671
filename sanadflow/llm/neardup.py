"""Near-duplicate texts by circulant MinHash (problem 4).

Signature coordinate ``k`` of a word set S is ``min(pi[(sigma(w) + k) mod D] for w in S)``:
two permutations of D positions, ``pi`` read at a circular shift for each coordinate, give
all coordinates. The slices of ``pi`` that start at ``sigma(w)`` hold them in a row, so a
signature is the element-wise minimum of as many slices as the set has words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sanadflow.llm.words import distinct_sorted, hashes, pieces, word_arrays
from sanadflow.operators.graph import components
from sanadflow.operators.pairs import expand_pairs
from sanadflow.plans.layout import alone_stored, hash128, spread, spread_by, stored, unstored

#: Words of 64 bits in a set's marks, a power of two; bands whose rows are moved at once, more while these are
#: no more than so many rows; parts of the candidates that are compared one after the other.
MARKS, AT_ONCE, ROWS, PARTS = 4, 6, 5_000_000, 4


@dataclass(frozen=True)
class MinHash:
    """Parameters. A pair of similarity s shares a band with probability
    ``1 - (1 - s**rows)**bands``: 0.94 at 0.6, 0.991 at 0.65, 0.9997 at 0.7 as set here.
    Candidates whose one-bit sketches differ in more than ``max_bits`` of 128 places are
    not verified: at similarity 0.6 that is four standard deviations off. None verifies all."""

    threshold: float = 0.6
    rows: int = 7
    bands: int = 96
    positions: int = 1 << 20
    max_bits: int | None = 44
    seed: int = 20


def word_sets(words: pa.Array, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of each text, as hashes."""
    return distinct_sorted(hashes(words), ends)


def shingle_sets(words: pa.Array, ends: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words, as hashes; a shorter text has one of all its words."""
    each, lengths = hashes(words).view(np.uint64), np.diff(ends)
    padded = np.concatenate([each, np.zeros(size, np.uint64)])
    owner = np.repeat(np.arange(len(lengths)), lengths)
    offset = np.arange(len(each)) - ends[:-1][owner]
    rolled = np.zeros(len(each), np.uint64)
    for j in range(size):
        inside = offset + j < lengths[owner]
        rolled = (rolled ^ np.where(inside, padded[j : j + len(each)], 0)) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(29)
    keep = offset < np.maximum(lengths - size + 1, 1)[owner]
    return distinct_sorted(rolled.view(np.int64)[keep], np.concatenate([[0], np.cumsum(np.minimum(lengths, np.maximum(lengths - size + 1, 1)))]))


def _sets(sets):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at, many in pieces(whole.column("text"), rows=4096):
                batch = whole.slice(at, many)
                values, ends = sets(*word_arrays(batch.column("text")))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["id", "words"])

    return run


@lru_cache(1)
def _slices(positions: int, length: int, seed: int) -> np.ndarray:
    """Row i is pi from position i on, read around the end; a view, not a copy."""
    pi = np.random.default_rng(seed).permutation(positions).astype(np.int32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:length]]), length)


def signatures(words: np.ndarray, ends: np.ndarray, p: MinHash, at_once: int = 1 << 15, first: int = 0, last: int | None = None) -> np.ndarray:
    """Signatures of the sets ``words[ends[i]:ends[i + 1]]``, none of them empty; memory is bounded by ``at_once`` words.
    Only coordinates from ``first`` to before ``last``, if given."""
    slices = _slices(p.positions, p.rows * p.bands, p.seed)[:, first:last]
    sigma = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 | 1)
    sigma = ((sigma >> np.uint64(20)) % np.uint64(p.positions)).astype(np.int64)
    out = np.full((len(ends) - 1, slices.shape[1]), np.iinfo(np.int32).max, np.int32)
    # Set by set: a minimum down whole rows runs at memory speed, which reduceat over many sets does not.
    for row, start, end in zip(out, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        for at in range(start, end, at_once):
            np.minimum(row, slices[sigma[at : min(at + at_once, end)]].min(axis=0), out=row)
    return out


def band_keys(sig: np.ndarray, p: MinHash, first: int = 0) -> np.ndarray:
    """Keys of the bands from ``first`` on that ``sig`` has coordinates of."""
    parts = sig.reshape(len(sig), -1, p.rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(first + 1, first + 1 + parts.shape[1], dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), parts.shape[:2]).copy()
    for j in range(p.rows):
        key = (key ^ parts[:, :, j]) * np.uint64(0xFF51AFD7ED558CCD)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def sketch_bits(sig: np.ndarray) -> np.ndarray:
    bits = np.packbits((sig[:, :128] & 1).astype(np.uint8), axis=1)
    return np.ascontiguousarray(bits).view(np.int64)


def marks(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each set, none of them empty, as ``MARKS`` words of 64 bits, every word at a bit of its hash."""
    place = (words.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)
    bit = np.uint64(1) << (place & np.uint64(63))
    at = (place >> np.uint64(6)) & np.uint64(MARKS - 1)
    return np.stack([np.bitwise_or.reduceat(np.where(at == k, bit, np.uint64(0)), ends[:-1]) for k in range(MARKS)], axis=1).view(np.int64)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of the batches with their sets ``words[ends[i]:ends[i + 1]]``."""
    for whole in batches:
        for at in range(0, whole.num_rows, 512):
            batch = whole.slice(at, 512)
            lists = batch.column("words")
            ends = np.asarray(lists.offsets, dtype=np.int64)
            yield batch, np.asarray(lists.values)[ends[0] : ends[-1]], ends - ends[0]


_MARKS = [f"m{k}" for k in range(MARKS)]
_MOVED = ["c1", "n", *_MARKS]


def possible(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sets may be as similar as ``threshold``; ``a`` and ``b`` have their sizes, then their marks. False only for
    sets that are not: every mark of one alone is of at least one word of it alone."""
    alone = lambda x, y: np.bitwise_count((x[1:] & ~y[1:]).view(np.uint64)).sum(axis=0, dtype=np.int64)
    most = np.minimum(a[0] - alone(a, b), b[0] - alone(b, a))
    return most >= (a[0] + b[0] - most) * (threshold - 1e-9)


def _marked(p: MinHash):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, ends in _lists(batches):
            bits = sketch_bits(signatures(words, ends, p, last=128))
            found = [*bits.T, np.diff(ends).astype(np.int32), *marks(words, ends).T]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("c1", "c2", "words")), *(pa.array(np.ascontiguousarray(x)) for x in found)], names=["c1", "c2", "words", "s1", "s2", "n", *_MARKS])

    return run


def _bands(p: MinHash, first: int, last: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, words, ends in _lists(batches):
            keys = band_keys(signatures(words, ends, p, first=first * p.rows, last=last * p.rows), p, first)
            again = lambda c: pa.array(np.repeat(np.asarray(batch.column(c)), last - first))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *map(again, _MOVED)], names=["band", *_MOVED])

    return run


def _together(p: MinHash, most: int = 1 << 20):
    """Pairs of one band from rows in the order of their bands; a band may go on in the next batch."""

    def pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        left = np.arange(len(rows[0]))
        for step in range(1, len(rows[0])):
            left = left[left + step < len(rows[0])]
            left = left[rows[0][left] == rows[0][left + step]]
            if not len(left):
                return
            for at in range(0, len(left), most):
                a, b = left[at : at + most], left[at : at + most] + step
                keep = possible(rows[2:, a], rows[2:, b], p.threshold)
                a, b = a[keep], b[keep]
                one, other = rows[1][a], rows[1][b]
                keep = one != other
                if keep.any():
                    yield pa.RecordBatch.from_arrays([pa.array(f(one, other)[keep]) for f in (np.minimum, np.maximum)], names=["c1_a", "c1_b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([np.asarray(batch.column(c)) for c in ("band", *_MOVED)])
            start = int(np.searchsorted(rows[0], rows[0][-1]))
            if start or held and held[0][0, 0] != rows[0, 0]:
                # All but the last band are whole.
                yield from pairs(np.concatenate([*held, rows[:, :start]], axis=1))
                held = []
            held.append(rows[:, start:])
        if held:
            yield from pairs(np.concatenate(held, axis=1))

    return run


def _candidates(classes: DataFrame, p: MinHash, at_once: int) -> DataFrame:
    """``c1_a, c1_b``: different sets that share a band and whose marks allow the similarity.

    ``at_once`` bands are moved at a time, and what was moved goes before the next ones: all of them would be many
    times the texts. A band's rows meet in one task, in order, and are held against each other there."""
    found = None
    for first in range(0, p.bands, at_once):
        bands = classes.select("words", *_MOVED).mapInArrow(_bands(p, first, min(first + at_once, p.bands)), "band long, c1 long, n int, " + ", ".join(f"{m} long" for m in _MARKS))
        pairs = spread_by(bands, "band").sortWithinPartitions("band").mapInArrow(_together(p), "c1_a long, c1_b long")
        pairs = stored(pairs.distinct())
        found = pairs if found is None else found.unionAll(pairs)
    return found.distinct()


def similar_classes(classes: DataFrame, p: MinHash, at_once: int | None = None) -> DataFrame:
    """Links between different sets of similarity ``p.threshold`` or more.

    ``classes`` has ``c1, c2`` (the set's hash), ``words``, and sketch, size and marks of the set. Band rows carry one
    hash, size and marks only; sets are fetched for the candidates that are left, one side after the other (two sets that
    happened to share the hash would both be), and their similarity is computed exactly if their sketches allow it.
    Result: ``c1_a, c2_a, c1_b, c2_b, similarity``.
    """
    if at_once is None:
        at_once = min(p.bands, max(AT_ONCE, ROWS // max(classes.count(), 1)))
    candidates = alone_stored(classes.sparkSession, lambda: _candidates(classes, p, at_once))
    side = lambda x: classes.select(*[F.col(c).alias(f"{c}_{x}") for c in ("c1", "c2", "words", "s1", "s2")])
    both = F.size(F.array_intersect("words_a", "words_b"))
    similarity = both / (F.size("words_a") + F.size("words_b") - both)
    apart = sum(F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in ("s1", "s2"))
    links = None
    for part in range(PARTS):
        mine = lambda df: df.where(F.pmod("c1_a", F.lit(PARTS)) == part)  # noqa: B023, E731
        half = stored(mine(candidates).join(mine(side("a")), "c1_a"))
        whole = half.join(side("b"), "c1_b")
        whole = whole if p.max_bits is None else whole.where(apart <= p.max_bits)
        found = stored(whole.select("c1_a", "c2_a", "c1_b", "c2_b", similarity.alias("similarity")).where(F.col("similarity") >= p.threshold))
        unstored(half)
        links = found if links is None else links.unionAll(found)
    unstored(candidates)
    return links


def _members(df: DataFrame, id_col: str, text: str, sets, p: MinHash) -> tuple[DataFrame, DataFrame]:
    """``id, c1, c2`` of every row with a word, and ``c1, c2, words, s1, s2, n`` and the marks of every distinct set.

    Both are tables in the shared folder, as links and similarities read them; words are kept once."""
    kind = df.schema[id_col].dataType.simpleString()
    texts = spread(df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))).where("text is not null")
    rows = stored(texts.mapInArrow(_sets(sets), f"id {kind}, words array<long>").where(F.size("words") > 0).select("id", "words", *hash128(F.col("words"), "c")))
    members = stored(rows.select("id", "c1", "c2"))
    classes = spread_by(rows.select("c1", "c2", "words"), "c1").dropDuplicates(["c1", "c2"])
    classes = stored(classes.mapInArrow(_marked(p), "c1 long, c2 long, words array<long>, s1 long, s2 long, n int, " + ", ".join(f"{m} long" for m in _MARKS)))
    unstored(rows)
    return members, classes


def similar_pairs(df: DataFrame, id_col: str, text: str, p: MinHash = MinHash(), sets=word_sets) -> DataFrame:
    """Pairs ``a < b`` of rows whose word sets have a Jaccard similarity of ``p.threshold`` or more.

    Rows with equal sets are one class in all comparisons and are expanded at the end.
    Null texts and texts without a word are in no pair; ids must be unique.
    """
    members, classes = _members(df, id_col, text, sets, p)
    links = similar_classes(classes, p).drop("similarity")
    several = members.groupBy("c1", "c2").count().where("count > 1")
    inside = several.select(F.col("c1").alias("c1_a"), F.col("c2").alias("c2_a"), F.col("c1").alias("c1_b"), F.col("c2").alias("c2_b"))
    return expand_pairs(links.unionByName(inside), members, ["c1", "c2"])


def similar_groups(df: DataFrame, id_col: str, text: str, p: MinHash = MinHash(), sets=word_sets) -> DataFrame:
    """``id, class_id, group_id, links`` for every row with a word: its class of equal sets,
    its connected group of similar classes and its class's number of links to other classes.

    Ids of classes and groups are hex strings made from the sets' hashes.
    """
    members, classes = _members(df, id_col, text, sets, p)
    name = lambda x="": F.concat(F.hex(f"c1{x}"), F.lit("-"), F.hex(f"c2{x}"))
    links = similar_classes(classes, p).select(name("_a").alias("a"), name("_b").alias("b"))
    degree = links.select("a").union(links.select("b")).groupBy(F.col("a").alias("class_id")).agg(F.count("*").alias("links"))
    groups = components(links).withColumnsRenamed({"node": "class_id", "component": "group_id"})
    rows = members.select("id", name().alias("class_id"))
    return rows.join(degree, "class_id", "left").join(groups, "class_id", "left").select("id", "class_id", F.coalesce("group_id", "class_id").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
