"""Languages of documents and of their stretches (problem 9).

Nearest-centroid classification: TF-IDF vectors of character n-grams, several clustered
centroids for each language, cosine, and rejection of what is far from every centroid.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sanadflow.llm.textform import look
from sanadflow.llm.words import pieces
from sanadflow.plans.layout import spread

# Bibliographic codes of ISO 639-2 and withdrawn codes, with the two-letter codes they stand for;
# names the platform's locale data do not give; what stands for no label.
OTHER_CODES = (
    "alb sq arm hy baq eu bur my chi zh cze cs dut nl fre fr geo ka ger de gre el ice is mac mk mao mi may ms per fa rum ro slo sk tib bo wel cy "
    "in id iw he ji yi arb ar cmn zh pes fa prs fa zsm ms ekk et lvs lv nob nb nno nn swh sw"
)
OTHER_NAMES = "farsi fa bahasa-indonesia id indonesia id turkce tr francais fr espanol es castilian es portugues pt persan fa mandarin zh"
MISSING = "und unknown none null nan na n/a - -- ? ?? xx xxx zxx mis mul unk undefined undetermined unspecified other"
#: Languages in which names of languages are known, besides each language's own.
NAMED_IN = ("en", "fr", "de", "es", "ar")

#: Ends of sentences, brackets and quotation marks part a text into stretches; line ends do if whole sentences stand between them.
_STRETCH = re.compile(r"[^.!?؟۔…()\[\]«»\"“”]+")
_LINE = re.compile(r"[^\n]+")
_OTHER = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Languages:
    """Parameters: labelled documents for each language that the centroids are fitted on (about as
    many, by the hash of the text), stretches taken of one of them, labels fitted at most, the most
    frequent ones, and labelled documents that make a language; cosine of two labels' centroids from
    which they are one language; centroids for each language; hashed n-gram dimensions; longest
    n-gram; words of a whole sentence; by how much a stretch must be nearer to another language
    than to the document's own; share of the cosine usual at a centroid below which it is rejected."""

    labelled: int = 400
    stretches: int = 200
    labels: int = 1000
    fewest: int = 3
    same: float = 0.95
    centroids: int = 3
    dimensions: int = 1 << 15
    longest: int = 3
    sentence: int = 4
    margin: float = 0.05
    rejected: float = 0.35
    seed: int = 5


@lru_cache(1)
def known_names() -> dict[str, str]:
    """Two-letter code of every language by its codes and names, lower case, from the locale data of the Java platform."""
    words = f"{OTHER_CODES} {OTHER_NAMES}".split()
    names = dict(zip(words[::2], words[1::2], strict=True))
    locale = SparkSession.active()._jvm.java.util.Locale
    shown = [locale.forLanguageTag(x) for x in NAMED_IN]
    codes = [(str(c), locale.forLanguageTag(str(c))) for c in locale.getISOLanguages()]
    for code, _ in codes:
        names.setdefault(code, code)
    for code, one in codes:
        code = names[code]
        names.setdefault(one.getISO3Language(), code)
        for other in (one, *shown):
            names.setdefault(one.getDisplayLanguage(other).lower(), code)
    return names


def code_of(label: str | None, names: dict[str, str]) -> str | None:
    """The two-letter code of a label; itself, lower case, if it is no known code or name; None if it is missing."""
    plain = " ".join((label or "").lower().split())
    if not plain or plain in MISSING.split():
        return None
    base = re.split(r"[-_]", plain)[0]
    return names.get(plain) or names.get(plain.replace(" ", "-")) or names.get(base) or (base if re.fullmatch("[a-z]{2,3}", base) else plain)


def label_code(label: Column) -> Column:
    """Column form of :func:`code_of`."""
    names = known_names()

    @F.pandas_udf(StringType())
    def coded(labels: pd.Series) -> pd.Series:
        # A list, so that what is missing stays null.
        found = {x: code_of(x, names) for x in labels.dropna().unique()}
        return pd.Series([found.get(x) for x in labels], dtype=object)

    return coded(label.cast("string"))


def stretches(text: str, least: int = 4) -> list[tuple[int, int, str, int]]:
    """``from, to, letters, words`` of each stretch; letters are folded, all else is one space.

    Lines of a stretch are stretches of their own unless one has fewer than ``least`` words: then
    the lines were broken inside sentences, and stay together."""
    out = []
    for m in _STRETCH.finditer(text):
        whole = m.group()
        lines = [(x.start(), x.end()) for x in _LINE.finditer(whole)] if "\n" in whole else [(0, len(whole))]
        plain = [_OTHER.sub(" ", look(whole[a:b]).casefold()).strip() for a, b in lines]
        held = [(a, b, x) for (a, b), x in zip(lines, plain, strict=True) if x]
        if len(held) > 1 and min(x.count(" ") + 1 for _, _, x in held) < least:
            held = [(held[0][0], held[-1][1], " ".join(x for _, _, x in held))]
        out += [(m.start() + a, m.start() + b, x, x.count(" ") + 1) for a, b, x in held]
    return out


def vectors(texts: list[str], p: Languages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-gram counts in sparse form: row, dimension, count."""
    joined = "\0".join(f" {t} " for t in texts) + "\0"
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    row = np.cumsum(codes == 0) - (codes == 0)
    keys = []
    rolled, inside = np.zeros(len(codes), np.uint64), np.ones(len(codes), bool)
    for n in range(1, p.longest + 1):
        rolled = rolled[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        inside = inside[: len(codes) - n + 1] & (codes[n - 1 :] != 0)
        mixed = (rolled + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        keys.append(row[: len(rolled)][inside] * p.dimensions + ((mixed >> np.uint64(40)) % np.uint64(p.dimensions)).astype(np.int64)[inside])
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return key // p.dimensions, key % p.dimensions, count


class Centroids:
    """Fitted model: inverse document frequencies, centroids, their languages and usual cosines."""

    def __init__(self, texts: list[str], labels: list[str], documents: dict[str, int], p: Languages):
        self.p = p
        row, dim, count = vectors(texts, p)
        self.idf = (np.log((1 + len(texts)) / (1 + np.bincount(dim, minlength=p.dimensions))) + 1).astype(np.float32)
        self.languages = sorted(set(labels))
        while True:
            y = np.array([self.languages.index(x) if x in self.languages else -1 for x in labels])
            had = np.bincount(y[y >= 0], minlength=len(self.languages))
            # First one centroid a language; stretches nearer to another one have a wrong label or are foreign, and are left out.
            self.of = np.arange(len(self.languages))
            alike = None
            for _ in range(2):
                self.centres = self._means(row, dim, count, y, len(self.languages))
                alike = self.centres.T @ self.centres if alike is None else alike
                nearest = self._without_itself(self.cosines(row, dim, count, len(texts)), y).argmax(axis=1)
                y = np.where(nearest == y, y, -1)
            # A label whose centroid is that of a label with more documents names no language of its own, nor does one most
            # of whose stretches are nearer to other languages: it is a wrong label. The least frequent goes first.
            held = np.bincount(y[y >= 0], minlength=len(self.languages))
            rank = lambda k: (documents[self.languages[k]], self.languages[k])
            wrong = [k for k in self.of if any(alike[k, j] >= p.same and rank(j) > rank(k) for j in self.of)] or [k for k in self.of if 2 * held[k] < had[k]]
            if not wrong or len(self.languages) == 1:
                break
            del self.languages[min(wrong, key=rank)]
        rng = np.random.default_rng(p.seed)
        part = np.where(y >= 0, y * p.centroids + rng.integers(0, p.centroids, len(y)), -1)
        self.of = np.repeat(np.arange(len(self.languages)), p.centroids)
        for _ in range(6):
            self.centres = self._means(row, dim, count, part, len(self.of))
            near = self.cosines(row, dim, count, len(texts))
            own = np.where(self.of[None, :] == y[:, None], near, -1)
            part = np.where(y >= 0, own.argmax(axis=1), -1)
        held = [near[part == k, k] for k in range(len(self.of))]
        self.usual = np.array([np.median(x) if len(x) else 1.0 for x in held], np.float32)

    def _weights(self, row, dim, count, rows):
        w = (1 + np.log(count)) * self.idf[dim]
        return w / np.sqrt(np.bincount(row, w * w, rows))[row]

    def _means(self, row, dim, count, group, groups):
        rows = len(group)
        w, g = self._weights(row, dim, count, rows), group[row]
        flat = np.bincount(g[g >= 0] * self.p.dimensions + dim[g >= 0], w[g >= 0], groups * self.p.dimensions).reshape(groups, -1)
        self.length = np.linalg.norm(flat, axis=1)
        return (flat / np.maximum(self.length[:, None], 1e-9)).T.astype(np.float32)

    def _without_itself(self, cos: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Cosines in which the centroid of a text's own group is that of the group's other texts."""
        at = np.flatnonzero(group >= 0)
        length, own = self.length[group[at]], cos[at, group[at]]
        rest = np.sqrt(np.maximum(length**2 - 2 * length * own + 1, 0))
        cos[at, group[at]] = np.where(rest > 1e-3, (length * own - 1) / np.maximum(rest, 1e-3), 0)
        return cos

    def cosines(self, row, dim, count, rows) -> np.ndarray:
        w = self._weights(row, dim, count, rows).astype(np.float32)
        out = np.zeros((rows, self.centres.shape[1]), np.float32)
        ends = np.searchsorted(row, np.arange(rows + 1)).tolist()
        for i in range(rows):
            here = slice(ends[i], ends[i + 1])
            out[i] = w[here] @ self.centres[dim[here]]
        return out

    def near(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Highest cosine to each language, 0 where every centroid of it is too far."""
        if not texts:
            return np.zeros((0, len(self.languages)), np.float32)
        cos, first, held = [], 0, 0
        for i, x in enumerate(texts):
            held += len(x)
            if held > 400_000 or i + 1 == len(texts):
                cos.append(self.cosines(*vectors(texts[first : i + 1], self.p), i + 1 - first))
                first, held = i + 1, 0
        cos = np.concatenate(cos)
        cos = np.where(cos >= self.p.rejected * self.usual, cos, 0)
        return np.stack([cos[:, self.of == k].max(axis=1) for k in range(len(self.languages))], axis=1)


def _sampled(p: Languages):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for code, text in zip(batch.column("code").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = [s[2] for s in stretches(text, p.sentence) if s[3] >= p.sentence]
                found = sorted(found, key=lambda x: xxhash.xxh3_64_intdigest(x))[: p.stretches]
                yield pa.RecordBatch.from_arrays([pa.array([code] * len(found), pa.string()), pa.array(found, pa.string())], names=["code", "stretch"])

    return run


def fit(docs: DataFrame, text: str, label: str, p: Languages = Languages()) -> Centroids | None:
    """Centroids from the stretches of a bounded sample of labelled documents; labels may be wrong in part.
    Every label is a language, be its name known or not, if ``p.fewest`` documents bear it and its
    stretches are nearer to one another than to those of other labels. Only labels and hashes are
    counted over all documents; texts leave their place only if sampled. None if there is no labelled text."""
    known = docs.select(F.col(text).alias("text"), label_code(F.col(label)).alias("code")).where("text is not null and code is not null")
    held = known.groupBy("code").agg(F.count("*").alias("n")).where(F.col("n") >= p.fewest).orderBy(F.desc("n"), "code").limit(p.labels).collect()
    if not held:
        return None
    shares = docs.sparkSession.createDataFrame([(r["code"], min(1 << 30, math.ceil((1 << 30) * p.labelled / r["n"]))) for r in held], "code string, upto long")
    chosen = known.join(F.broadcast(shares), "code").where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.col("upto")).select("code", "text")
    pairs = sorted({(r["code"], r["stretch"]) for r in chosen.mapInArrow(_sampled(p), "code string, stretch string").collect()})
    if not pairs:
        return None
    return Centroids([x for _, x in pairs], [c for c, _ in pairs], {r["code"]: r["n"] for r in held}, p)


_SEGMENT = "struct<from:int,to:int,lang:string,confidence:double,words:int>"


def _tag(model: Centroids | None, names: dict[str, str], p: Languages):
    kind = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("words", pa.int32())]))

    def confidence(cos: np.ndarray) -> np.ndarray:
        z = np.exp(20 * (cos - cos.max(axis=1, keepdims=True, initial=-1)))
        return z / z.sum(axis=1, keepdims=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at, many in pieces(whole.column("text"), 400_000):
                batch = whole.slice(at, many)
                parts = [stretches(x, p.sentence) if x else [] for x in batch.column("text").to_pylist()]
                # Sentences that recur are weighed once.
                flat = pa.array([s[2] for x in parts for s in x], pa.string()).dictionary_encode()
                cos = model.near(flat.dictionary.to_pylist()) if model else np.zeros((len(flat.dictionary), 1), np.float32)
                cos = cos[np.asarray(flat.indices, np.int64)]
                sure = confidence(cos)
                size = np.array([s[3] for x in parts for s in x], np.float64)
                langs, sures, segments, first = [], [], [], 0
                for x in parts:
                    own, weight = cos[first : first + len(x)], size[first : first + len(x), None]
                    total = (own * weight).sum(axis=0)
                    if not len(x) or total.max() <= 0:
                        langs.append("und")
                        sures.append(0.0)
                        segments.append([(s[0], s[1], "und", 0.0, s[3]) for s in x])
                    else:
                        main = int(total.argmax())
                        best = own.argmax(axis=1)
                        other = (own.max(axis=1) > own[:, main] + p.margin) & (weight[:, 0] >= p.sentence)
                        pick = np.where(other, best, main)
                        chance = sure[first : first + len(x)][np.arange(len(x)), pick]
                        langs.append(model.languages[main])
                        sures.append(float(np.average(sure[first : first + len(x)][pick == main, main], weights=weight[pick == main, 0]) if (pick == main).any() else chance.max()))
                        segments.append([(s[0], s[1], model.languages[k], float(q), s[3]) for s, k, q in zip(x, pick, chance, strict=True)])
                    first += len(x)
                keys = ("from", "to", "lang", "confidence", "words")
                codes = {x: code_of(x, names) for x in set(batch.column("label").to_pylist())}
                labels = pa.array([codes[x] for x in batch.column("label").to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(langs, pa.string()), pa.array(sures, pa.float64()), pa.array([[dict(zip(keys, s, strict=True)) for s in x] for x in segments], kind), labels], names=["id", "lang", "confidence", "segments", "label"])

    return run


def languages(docs: DataFrame, doc_id: str, text: str, label: str, p: Languages = Languages(), model: Centroids | None = None) -> DataFrame:
    """``doc_id, lang, confidence, segments, label``: the language of every document with a text, and of each
    of its stretches (character positions, from inclusive, to exclusive).

    ``label`` is the delivered label's two-letter code, or the label itself if it is no known
    code or name; null if missing. Stretches of fewer than ``p.sentence`` words, such as foreign terms, take the
    document's language. A text far from all languages, or without letters, is ``und`` with
    confidence 0, and so is every text where no labels are to learn from; null texts give no row. Whole texts are read; nothing is shuffled.
    """
    model = model or fit(docs, text, label, p)
    rows = spread(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(label).cast("string").alias("label"))).where("text is not null")
    kind = docs.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(_tag(model, known_names(), p), f"id {kind}, lang string, confidence double, segments array<{_SEGMENT}>, label string").withColumnRenamed("id", doc_id)


def mislabelled(docs: DataFrame, doc_id: str, text: str, label: str, p: Languages = Languages()) -> DataFrame:
    """``doc_id, lang``: one row for each language held by a document whose label is missing or
    wrong, or that holds a whole sentence in a second language. A document with words but
    without a label, in none of the languages, comes out as ``und``; one with a label does not."""
    found = languages(docs, doc_id, text, label, p)
    whole = F.filter("segments", lambda s: (s["words"] >= p.sentence) & (s["lang"] != "und"))
    held = F.array_union(F.array("lang"), F.transform(whole, lambda s: s["lang"]))
    known = found.select(doc_id, "lang", "label", held.alias("held"), (F.size("segments") > 0).alias("some"))
    wrong = F.when(F.col("lang") == "und", F.col("label").isNull() & F.col("some")).otherwise((F.size("held") > 1) | F.col("label").isNull() | (F.col("label") != F.col("lang")))
    return known.where(wrong).select(doc_id, F.explode("held").alias("lang"))
