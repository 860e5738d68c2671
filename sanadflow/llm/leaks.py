"""Evaluation passages inside a corpus (problem 7).

Each shard of the corpus gets an FM-index over word numbers: suffix order, Burrows-Wheeler
transform, a wavelet matrix for ranks, and every eighth suffix position. All phrases of all
test items are searched backwards at once; the rarest phrase of every stretch of an item
is located, matched onward along its diagonal, and the matching stretches are merged to spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sanadflow.llm.words import hashes, pieces, words_of
from sanadflow.plans.layout import cut, hash128, spread, spread_by, stored


class FMIndex:
    """FM-index of an integer text whose last symbol is 0, over symbols below ``alphabet``. All queries are vectorised."""

    def __init__(self, text: np.ndarray, alphabet: int, sample: int = 8):
        n = len(text)
        order = _suffix_order(text)
        bwt = text[order - 1]
        self.n, self.levels = n, max(1, (alphabet - 1).bit_length())
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])
        self.ones, self.zeros = [], []
        row = bwt
        for level in range(self.levels - 1, -1, -1):
            bit = (row >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(n - int(self.ones[-1][-1]))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        kept = order % sample == 0
        self.kept_before = np.concatenate([[0], np.cumsum(kept, dtype=np.int32)])
        self.kept, self.positions = kept, order[kept]

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Times that ``symbol`` stands in the transform before ``upto``."""
        low, high = np.zeros_like(upto), upto
        for ones, zeros, level in zip(self.ones, self.zeros, range(self.levels - 1, -1, -1), strict=True):
            bit = (symbol >> level) & 1
            low = np.where(bit, zeros + ones[low], low - ones[low])
            high = np.where(bit, zeros + ones[high], high - ones[high])
        return high - low

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            bit = ones[at + 1] - ones[at]
            out = out * 2 + bit
            at = np.where(bit, zeros + ones[at], at - ones[at])
        return out

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of the rows of ``phrases``: the suffixes ``low..high`` that start with each."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for symbol in phrases.T[::-1]:
            start = self.first[symbol]
            low, high = start + self.rank(symbol, low), start + self.rank(symbol, high)
        return low, high

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: steps back through the text to the next sampled one."""
        found, todo, steps = np.zeros(len(at), np.int64), np.arange(len(at)), 0
        at = at.copy()
        while len(todo):
            done = self.kept[at]
            found[todo[done]] = self.positions[self.kept_before[at[done]]] + steps
            todo, at = todo[~done], at[~done]
            c = self.symbol(at)
            at, steps = self.first[c] + self.rank(c, at), steps + 1
        return found


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling."""
    n, width = len(text), 1
    rank = text.astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - width)] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        width *= 2


@dataclass(frozen=True)
class Leaks:
    """Parameters: words of a phrase; share of an item's words that makes a leak; words of one
    stretch that make one by themselves (None: no stretch does); most stretches that may make up
    the share, in the item's order (1 or 2), or None for any number in any order; words of a stretch
    that counts; what a phrase must not exceed in other documents, as a share of them and at
    least, to be more than a set phrase of the language; words of an index shard; items searched
    at once, and items searched with one build of the indexes, which are sent to every executor."""

    phrase: int = 4
    share: float = 0.4
    run: int | None = 20
    stretches: int | None = None
    least: int = 6
    common: float = 0.001
    common_least: int = 10
    shard: int = 1 << 20
    block: int = 2000
    items: int = 100_000


_OUT = "doc {}, item int, a int, b int, n int, diag int, around long, at array<int>, eq array<int>, hits long"
_COLUMNS = ("doc", "item", "a", "b", "n", "diag", "around", "at", "eq", "hits")
_AROUND = 8


class _Items:
    """Word hashes of numbered items, and their words' numbers in the vocabulary of all: 1 is any other word, 0 ends a text."""

    def __init__(self, texts: list[list[str]]):
        self.ends = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
        flat = hashes(pa.array([w for x in texts for w in x], pa.string()))
        self.vocabulary = np.unique(flat)
        self.flat = self.number(flat)

    def number(self, hashed: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashed), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashed, at + 2, 1)

    def block(self, first: int, many: int) -> np.ndarray:
        """The items' words, one row an item, filled up with -1."""
        ends = self.ends[first : first + many + 1]
        sizes = np.diff(ends)
        wide = np.full((len(sizes), int(sizes.max())), -1, np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        wide[row, np.arange(ends[0], ends[-1]) - ends[:-1][row]] = self.flat[ends[0] : ends[-1]]
        return wide


def _scan(shipped, kind: pa.DataType, p: Leaks):
    """mapInArrow function: matching stretches (doc not null); by item and phrase, the number of hits, and under item -1
    the number of texts (doc null). A shard is indexed once, and all items are searched in it."""

    def batch(**columns) -> pa.RecordBatch:
        ints = pa.list_(pa.int32())
        kinds = dict(zip(_COLUMNS, (kind, *[pa.int32()] * 5, pa.int64(), ints, ints, pa.int64()), strict=True))
        size = len(next(iter(columns.values())))
        made = [c.cast(t) if isinstance(c := columns.get(name), pa.Array) else pa.nulls(size, t) if c is None else pa.array(c, t) for name, t in kinds.items()]
        return pa.RecordBatch.from_arrays(made, names=list(kinds))

    def shard(ids: pa.Array, ends: np.ndarray, words: pa.Array) -> Iterator[pa.RecordBatch]:
        items = shipped.value
        sizes = np.diff(ends)
        starts = ends[:-1] + np.arange(len(ids))  # a 0 ends every document
        text, hashed = np.zeros((2, int(ends[-1]) + len(ids)), np.int64)
        laid = np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])
        hashed[laid] = hashes(words)
        text[laid] = items.number(hashed[laid])
        index = FMIndex(text, len(items.vocabulary) + 2)
        yield batch(item=[-1], hits=[len(ids)])
        for number in range(0, len(items.ends) - 1, p.block):
            yield from search(index, ids, text, hashed, starts, sizes, items.block(number, p.block), number)

    def search(index, ids, text, hashed, starts, sizes, wide, number) -> Iterator[pa.RecordBatch]:
        k = p.phrase
        which, at = np.nonzero(wide[:, k - 1 :] >= 0)
        low, high = index.search(wide[which[:, None], at[:, None] + np.arange(k)])
        hits = high - low
        seen = np.flatnonzero(hits > 0)
        yield batch(item=which[seen] + number, a=at[seen], hits=hits[seen])
        # Every phrase that is rare here, and the rarest of each stretch of `least` words.
        most, span = np.iinfo(np.int64).max, max(1, p.least - k + 1)
        window = np.arange(len(at))[:, None] + np.arange(span)
        inside = np.minimum(window, len(at) - 1)
        near = (window < len(at)) & (which[inside] == which[:, None])
        best = np.arange(len(at)) + np.where(near, np.where(hits > 0, hits, most)[inside], most).argmin(axis=1)
        chosen = (hits > 0) & (hits <= p.common_least + p.common * len(ids))
        chosen[best[hits[best] > 0]] = True
        pick = np.flatnonzero(chosen)
        times = hits[pick]
        suffix = np.repeat(low[pick] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
        place = index.locate(suffix)
        doc = np.searchsorted(starts, place, "right") - 1
        seed = np.unique(np.stack([doc, np.repeat(which[pick], times), place - starts[doc] - np.repeat(at[pick], times)]), axis=1)
        for i in range(0, seed.shape[1], 20000):
            doc, item, a, b, n, diag, around, phrases, equal = _stretches(text, hashed, starts, sizes, wide, seed[:, i : i + 20000], p)
            yield batch(doc=ids.take(pa.array(doc)), item=item + number, a=a, b=b, n=n, diag=diag, around=around, at=phrases, eq=equal)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, ends = [], [], [np.zeros(1, np.int64)]
        for whole in batches:
            # Texts are taken in small pieces, so that a shard stays bounded when they are long.
            for first, many in pieces(whole.column("text"), 4 * p.shard):
                part = whole.slice(first, many)
                each = pc.split_pattern(part.column("text"), " ")
                now, stops = each.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(each).to_numpy(zero_copy_only=False))]).astype(np.int64)
                ids.append(part.column("doc"))
                words.append(now)
                ends.append(stops[1:] + ends[-1][-1])
                if ends[-1][-1] >= p.shard:
                    yield from shard(pa.concat_arrays(ids), np.concatenate(ends), pa.concat_arrays(words))
                    ids, words, ends = [], [], [np.zeros(1, np.int64)]
        if ids:
            yield from shard(pa.concat_arrays(ids), np.concatenate(ends), pa.concat_arrays(words))

    return run


def _stretches(text, hashed, starts, sizes, wide, seed, p: Leaks):
    """Along each diagonal (doc, item, shift): maximal stretches in which a changed word costs three equal ones."""
    doc, item, diag = seed
    place = diag[:, None] + np.arange(wide.shape[1])
    inside = (place >= 0) & (place < sizes[doc][:, None]) & (wide[item] >= 0)
    equal = inside & (text[np.where(inside, starts[doc][:, None] + place, 0)] == wide[item])
    score, peak, begin, end = (np.zeros(len(doc), np.int64) for _ in range(4))
    found = []

    def close(mask):
        use = np.flatnonzero(mask & (end - begin >= p.least))
        if len(use):
            found.append((use, begin[use].copy(), end[use].copy()))

    for j in range(wide.shape[1] + 1):
        now = equal[:, j] if j < wide.shape[1] else np.zeros(len(doc), bool)
        fresh = now & (score <= 0)
        begin[fresh], end[fresh], score[fresh], peak[fresh] = j, j, 0, 0
        score = score + np.where(now, 1, -3)
        up = now & (score > peak)
        peak[up], end[up] = score[up], j + 1
        over = (score <= 0) | (peak - score > 6) | (j == wide.shape[1])
        over &= peak > 0
        close(over)
        score[over | (score < 0)] = 0
        peak[over] = 0
    if not found:
        return [np.zeros(0, np.int64)] * 7 + [[], []]
    use, a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    run = np.concatenate([np.zeros((len(doc), 1), np.int64), np.cumsum(equal, axis=1)], axis=1)
    n = run[use, b] - run[use, a]
    use, a, b, n = (x[n >= p.least] for x in (use, a, b, n))
    k = p.phrase
    full = run[:, k:] - run[:, :-k] == k
    lists = [np.flatnonzero(full[u, x : y - k + 1]) + x for u, x, y in zip(use, a, b, strict=True)]
    # The words on both sides in the document, as one number: copies have them in common.
    near = np.concatenate([(a + diag[use])[:, None] - np.arange(1, _AROUND + 1), (b + diag[use])[:, None] + np.arange(_AROUND)], axis=1)
    within = (near >= 0) & (near < sizes[doc[use]][:, None])
    around = np.zeros(len(use), np.uint64)
    for word in np.where(within, hashed[np.where(within, starts[doc[use]][:, None] + near, 0)], 0).view(np.uint64).T:
        around = (around ^ word) * np.uint64(0x9E3779B97F4A7C15)
        around ^= around >> np.uint64(29)
    same = [np.flatnonzero(equal[u, x:y]) + x if p.stretches is None else () for u, x, y in zip(use, a, b, strict=True)]
    return [doc[use], item[use], a, b, n, diag[use], around.view(np.int64), lists, same]


def _combined(parts: DataFrame, p: Leaks) -> DataFrame:
    """``doc, item, n``: documents that hold the share of the item's words, or a long stretch, and the words they hold."""
    enough = F.col("n") >= F.ceil(F.col("words") * p.share)
    one = parts.select("doc", "item", "n", "words")
    if p.stretches is None:
        # Words of the item that stand in any stretch: each once, and for each another word of the document.
        places = parts.select("doc", "item", "words", "diag", F.explode("eq").alias("pos"))
        every = places.groupBy("doc", "item", "words").agg(F.least(F.count_distinct("pos"), F.count_distinct(F.col("pos") + F.col("diag"))).alias("n"))
    elif p.stretches == 2:
        x, y = (parts.select("doc", "item", "words", *[F.col(c).alias(f"{c}{i}") for c in ("a", "b", "n", "diag")]) for i in (1, 2))
        two = x.join(y, ["doc", "item", "words"]).where("b1 <= a2 and b1 + diag1 <= a2 + diag2").select("doc", "item", (F.col("n1") + F.col("n2")).alias("n"), "words")
        every = one.unionAll(two)
    elif p.stretches == 1:
        every = one
    else:
        raise ValueError("stretches must be 1, 2 or None")
    found = every.where(enough).select("doc", "item", "n")
    if p.run is not None:
        found = found.unionByName(one.where(F.col("n") >= p.run).select("doc", "item", "n"))
    return found.groupBy("doc", "item").agg(F.max("n").alias("n"))


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, p: Leaks = Leaks()) -> DataFrame:
    """``doc_id, item_id, share, spans``: documents that hold at least ``p.share`` of an item's words
    in stretches of ``p.least`` words or more, single changed words aside, or one stretch of ``p.run``.

    Any number of stretches in any order make up the share, each word of the item counted once,
    unless ``p.stretches`` allows one or two in the item's order only.
    ``spans`` are the merged removal spans, as ``struct<from, to>`` of word numbers of the
    document (see :func:`words_of`), from inclusive, to exclusive; :func:`in_characters` turns them
    into places of the text. A stretch counts only if
    it holds a phrase that is not common in documents without the item, as set phrases of
    the language would otherwise pass for quotations. Documents of the same words count as
    one there, and so do stretches that stand between the same words. Every document is
    indexed whole, those of the same words once, and all items are searched in an index when it is built.
    Items are the query side: they are read to the driver, ``p.items`` of them at a time.
    Null ids and texts, texts without words and items of fewer than ``p.phrase`` words give no row; ids must be unique.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType
    given = spread(docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).where("doc is not null and text is not null"))
    forms = stored(given.mapInArrow(_forms, f"doc {kind.simpleString()}, text string").where("text <> ''").select("*", *hash128(F.col("text"))))
    first = stored(forms.groupBy("h1", "h2").agg(F.min("doc").alias("first")))
    copies = forms.select("h1", "h2", F.col("doc").alias("copy")).join(first, ["h1", "h2"]).select("copy", F.col("first").alias("doc"))
    corpus = spread_by(forms.select("doc", "text"), "doc").join(spread_by(first.select(F.col("first").alias("doc")), "doc"), "doc", "left_semi")
    known = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).where("id is not null and text is not null")
    groups = -(-known.count() // p.items)
    found = None
    for group in range(groups):
        rows = known.where(F.pmod(F.xxhash64("id"), F.lit(groups)) == group).collect()
        rows = sorted(((r[0], w) for r in rows if len(w := words_of(r[1])) >= p.phrase), key=lambda r: r[0])
        if not rows:
            continue
        sizes = spark.createDataFrame([(i, r[0], len(r[1])) for i, r in enumerate(rows)], f"item int, given {dict(items.dtypes)[item_id]}, words int")
        scanned = cut(corpus.mapInArrow(_scan(spark.sparkContext.broadcast(_Items([w for _, w in rows])), to_arrow_type(kind), p), _OUT.format(kind.simpleString())))
        part = _telling(scanned, sizes.select("item", "words"), p).join(F.broadcast(sizes.drop("words")), "item")
        part = part.join(copies, "doc").select(F.col("copy").alias(doc_id), F.col("given").alias(item_id), "share", "spans")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"{doc_id} {kind.simpleString()}, {item_id} {dict(items.dtypes)[item_id]}, share double, spans array<struct<from:int,to:int>>")
    return found


def in_characters(docs: DataFrame, doc_id: str, text: str, found: DataFrame) -> DataFrame:
    """``found`` (see :func:`leaks`) with ``spans`` as places of characters in the text as stored.

    A span takes in whole what stands between blanks, marks included, and what stands between its words."""
    others = [c for c in found.columns if c not in (doc_id, "spans")]
    rows = docs.select(F.col(doc_id), F.col(text).alias("_text")).join(found, doc_id).select(doc_id, *others, "_text", "spans")
    out = "array<struct<from:int,to:int>>"
    schema = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in (doc_id, *others))
    return rows.mapInArrow(_located, f"{schema}, spans {out}")


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
    for batch in batches:
        places, last = [], None
        for text, spans in zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            if text != last:
                starts, ends, last = [], [], text
                for m in re.finditer(r"\S+", text):
                    many = len(words_of(m.group()))
                    starts += [m.start()] * many
                    ends += [m.end()] * many
            places.append([{"from": starts[s["from"]], "to": ends[s["to"] - 1]} for s in spans])
        kept = [c for c in batch.schema.names if c not in ("_text", "spans")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(places, kind)], names=[*kept, "spans"])


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow function: the words of each text with one space between them."""
    for whole in batches:
        for first, many in pieces(whole.column("text")):
            batch = whole.slice(first, many)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array([" ".join(words_of(x)) for x in batch.column("text").to_pylist()], pa.string())], names=["doc", "text"])


def _telling(scanned: DataFrame, sizes: DataFrame, p: Leaks) -> DataFrame:
    """``doc, item, share, spans`` from what the scan found, after stretches of set phrases are left out."""
    parts = scanned.where("doc is not null").join(F.broadcast(sizes), "item")
    total = scanned.where("item = -1").agg(F.sum("hits").alias("docs"))
    hits = scanned.where("doc is null and item >= 0").groupBy("item", F.col("a").alias("pos")).agg(F.sum("hits").alias("hits"))
    phrases = parts.select("doc", "item", "diag", "a", "around", F.explode("at").alias("pos"))
    # What does not count against a phrase: documents that hold the share, and stretches between the same words but one.
    held = phrases.join(_combined(parts, p).select("doc", "item", F.lit(1).alias("whole")), ["doc", "item"], "left")
    alike = held.groupBy("item", "pos", F.when(F.col("whole").isNull(), F.col("around")).alias("around"), "whole").agg(F.count("*").alias("n"))
    inside = alike.groupBy("item", "pos").agg(F.sum(F.col("n") - F.when(F.col("whole").isNull(), 1).otherwise(0)).alias("own"))
    limit = F.greatest(F.lit(p.common_least), F.col("docs") * p.common)
    rare = hits.join(inside, ["item", "pos"], "left").join(F.broadcast(total)).where(F.col("hits") - F.coalesce("own", F.lit(0)) <= limit).select("item", "pos")
    telling = phrases.join(rare, ["item", "pos"], "left_semi").select("doc", "item", "diag", "a").distinct()
    parts = parts.join(telling, ["doc", "item", "diag", "a"], "left_semi")
    spans = F.array_sort(F.collect_set(F.struct((F.col("a") + F.col("diag")).alias("from"), (F.col("b") + F.col("diag")).alias("to"))))
    joined = parts.join(_combined(parts, p).withColumnRenamed("n", "best"), ["doc", "item"])
    return joined.groupBy("doc", "item").agg((F.max("best") / F.max("words")).alias("share"), spans.alias("spans")).withColumn("spans", _merged(F.col("spans")))


def _merged(spans):
    """Overlapping or touching spans of a sorted array as one."""
    last = lambda acc: F.element_at(acc, -1)
    grow = lambda acc, s: F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last(acc)["from"].alias("from"), F.greatest(last(acc)["to"], s["to"]).alias("to"))))
    add = lambda acc, s: F.when((F.size(acc) > 0) & (last(acc)["to"] >= s["from"]), grow(acc, s)).otherwise(F.concat(acc, F.array(s)))
    return F.aggregate(spans, F.slice(spans, 1, 0), lambda acc, s: F.when(F.size(acc) == 0, F.array(s)).otherwise(add(acc, s)))
