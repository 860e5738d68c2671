"""Subject areas of documents (problem 2).

Complement naive Bayes is trained on a bounded sample of labelled documents and on the
lexicon; its word weights are refined by expectation-maximisation over the sentences of all
documents, labelled or not; and the score of a document's sentences for a subject is
calibrated, on labelled documents held out, to an independent posterior for each subject.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sanadflow.llm.textform import look
from sanadflow.llm.words import hashes
from sanadflow.plans.layout import spread, stored

_END = ".!?؟۔"
FAR = 12.0
_MARKS = "\"'()[]{}«»,;:،؛…" + _END


@dataclass(frozen=True)
class Subjects:
    """Parameters: labelled documents that the first model and the calibration are fitted on,
    about as many, by the hash of their id, one half for each; hashed words of the model; rounds of
    expectation-maximisation; share of a telling word's log odds below which a word says nothing; smoothing, and rows from which a word's weight is half believed; bounds of
    one word's weight; telling words that a sentence about a subject should weigh; log odds within which it is about several; sentences that a subject takes, and whether
    a document of fewer sentences may make do with those it has; least posterior; labelled documents that weigh as much in
    a subject's calibration as the calibration of all."""

    labelled: int = 20_000
    words: int = 1 << 18
    rounds: int = 3
    telling: float = 0.25
    smoothing: float = 0.3
    believed: float = 3.0
    most: float = 4.0
    least: float = -2.0
    against: float = 1.8
    close: float = 1.0
    sentences: int = 2
    fewer: bool = True
    posterior: float = 0.5
    pooled: float = 20.0


def sentences_of(text: str) -> list[str]:
    """Sentences as their words, in lower case and without marks."""
    out, words = [], []
    for token in look(text).replace("\n", " . ").lower().split():
        end = token[-1] in _END
        token = token.strip(_MARKS)
        if token:
            words.append(token)
        if end and words:
            out.append(" ".join(words))
            words = []
    if words:
        out.append(" ".join(words))
    return out


def _numbers(sentences: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of all sentences in a row, and the sentence of each."""
    lists = pc.split_pattern(sentences, " ")
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return (hashes(lists.flatten()).view(np.uint64) % np.uint64(words)).astype(np.int64), owner


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sentences_of(x) if x else [] for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(pa.string())), batch.column("labels")], names=["id", "sentences", "labels"])


class _Model:
    """Weights of words for subjects: log odds of a word in a subject against its complement, the other subjects."""

    def __init__(self, counts: np.ndarray, p: Subjects):
        # counts: words x (subjects + 1), the last column for sentences about no subject. Subjects are weighed
        # against each other, so a word that all of them use alike weighs nothing; none is weighed against all.
        self.p = p
        seen = counts.sum(axis=1)
        held = counts[:, :-1] + p.smoothing
        rest = held.sum(axis=1, keepdims=True) - held
        met = seen > 0
        odds = np.clip(np.log(held / held[met].sum(axis=0)) - np.log(rest / rest[met].sum(axis=0)), p.least, p.most) * (seen / (seen + p.believed))[:, None]
        # What a telling word of a subject weighs here: the fifth best of each, in the middle of the subjects.
        typical = max(float(np.median(np.partition(odds, -5, axis=0)[-5])), 0.1)
        self.none = p.against * typical
        # Many weak words together would outweigh telling ones, and feed on themselves from round to round.
        odds[np.abs(odds) < p.telling * typical] = 0
        every, none = held.sum(axis=1), counts[:, -1] + p.smoothing * held.shape[1]
        against = np.log(none / none[met].sum()) - np.log(every / every[met].sum()) if counts[:, -1].any() else np.zeros(len(counts))
        weights = (odds - np.where(met & (np.abs(against) >= p.telling), np.clip(against, -1, 1), 0)[:, None]).astype(np.float32)
        # The model travels with every task: only words that weigh anything do, and a row of nothing for the others.
        self.words = np.flatnonzero(weights.any(axis=1))
        self.weights = np.concatenate([weights[self.words], np.zeros((1, weights.shape[1]), np.float32)])

    def scores(self, sentences: pa.Array) -> np.ndarray:
        word, owner = _numbers(sentences, self.p.words)
        out = np.zeros((len(sentences), self.weights.shape[1]), np.float32)
        if len(word) and len(self.words):
            at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
            at = np.where(self.words[at] == word, at, len(self.words))
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            out[owner[first]] = np.add.reduceat(self.weights[at], first, axis=0)
        return out


def _posterior(scores: np.ndarray, none: float) -> np.ndarray:
    """Shares of the subjects, and of none, in each sentence."""
    z = np.concatenate([scores, np.full((len(scores), 1), none, np.float32)], axis=1)
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _expect(model: _Model, p: Subjects):
    """mapInArrow function: expected counts of (word, subject) over sentences with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((p.words, model.weights.shape[1] + 1), np.float32)
        for batch in batches:
            sentences = batch.column("sentence")
            share = _posterior(model.scores(sentences), model.none) * np.asarray(batch.column("n"), np.float64)[:, None]
            word, owner = _numbers(sentences, p.words)
            order = np.argsort(word, kind="stable")
            if len(order):
                at = np.flatnonzero(np.diff(word[order], prepend=-1))
                total[word[order][at]] += np.add.reduceat(share[owner[order]], at, axis=0)
        w, c = np.nonzero(total > 1e-4)
        yield pa.RecordBatch.from_arrays([pa.array(w, pa.int32()), pa.array(c, pa.int32()), pa.array(total[w, c].astype(np.float64))], names=["w", "c", "n"])

    return run


def _kth(scores: np.ndarray, row: np.ndarray, rows: int, p: Subjects) -> np.ndarray:
    """The score of each row's k-th best sentence for each subject, within +-FAR; -FAR where there are fewer.
    A sentence counts for its best subjects only: words shared by subjects say little for the others."""
    scores = np.clip(np.where(scores >= scores.max(axis=1, keepdims=True) - p.close, scores, -FAR), -FAR, FAR)
    out = np.full((rows, scores.shape[1]), -FAR, np.float32)
    k = np.full(rows, p.sentences)
    if p.fewer:
        k = np.minimum(k, np.maximum(np.bincount(row, minlength=rows), 1))
    for c in range(scores.shape[1]):
        use = np.flatnonzero(scores[:, c] > -FAR)
        order = use[np.lexsort((-scores[use, c], row[use]))]
        r = row[order]
        at = np.arange(len(r)) - np.searchsorted(r, r) == k[r] - 1
        out[r[at], c] = scores[order[at], c]
    return out


def _logistic(x: np.ndarray, y: np.ndarray, start: np.ndarray | None = None, weight: float = 1e-3) -> np.ndarray:
    """Intercept and slope, by Newton steps that are halved until they improve the likelihood; ``weight`` draws them to ``start``."""
    z = np.stack([np.ones_like(x), x], axis=1)
    centre = np.zeros(2) if start is None else start
    loss = lambda b: np.logaddexp(0, z @ b).sum() - y @ (z @ b) + weight * (b - centre) @ (b - centre)
    b = centre.copy()
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(z @ b, -500, 500)))
        step = np.linalg.solve((z * (q * (1 - q))[:, None]).T @ z + 2 * weight * np.eye(2), z.T @ (y - q) - 2 * weight * (b - centre))
        size = 1.0
        while loss(b + size * step) > loss(b) and size > 1e-6:
            size /= 2
        b = b + size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return b


def _calibrated(best: np.ndarray, truth: np.ndarray, none: float, p: Subjects) -> np.ndarray:
    """Intercept and slope of each subject, from held-out labelled documents, drawn to those of all subjects together."""
    if not truth.any():
        return np.tile([-none, 1.0], (best.shape[1], 1))
    together = _logistic(best.ravel().astype(np.float64), truth.ravel())
    return np.array([_logistic(x.astype(np.float64), y, together, p.pooled) for x, y in zip(best.T, truth.T, strict=True)])


def _assign(model: _Model, calibration: np.ndarray, p: Subjects):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("sentences")
            ends = np.asarray(lists.offsets, np.int64)
            flat = lists.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
            scores = model.scores(flat.dictionary)[np.asarray(flat.indices, np.int64)]
            row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            best = _kth(scores, row, batch.num_rows, p)
            chance = 1 / (1 + np.exp(-np.clip(calibration[:, 0] + calibration[:, 1] * best, -30, 30)))
            r, c = np.nonzero((chance >= p.posterior) & (best > -FAR))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(r)), pa.array(c, pa.int32()), pa.array(chance[r, c].astype(np.float64))], names=["id", "c", "posterior"])

    return run


def _plain(name: str) -> str:
    return " ".join(name.lower().replace("&", " and ").split())


def subjects(docs: DataFrame, doc_id: str, text: str, labels: str, lexicon: DataFrame, p: Subjects = Subjects()) -> DataFrame:
    """``doc_id, topic, posterior``: the subjects of ``lexicon`` that each document is about.

    A subject is assigned where its calibrated posterior, from the score of the document's
    ``p.sentences``-th best sentence, reaches ``p.posterior``; a document of fewer sentences needs all of
    its own unless ``p.fewer`` is off. ``labels`` is an array column of
    names as delivered: it is compared after folding case, spaces and ``&``/``and``; null,
    empty, unknown names and repeats say nothing. ``lexicon`` has ``topic, topic_ord, keyword``.
    All documents are split, counted in expectation-maximisation and scored whole, all of their words are in the
    model, by their hashes; only the first model and the calibration use the sample, each another half. Null and empty texts, and documents
    about no subject, give no row. Without labels the lexicon alone starts the model, and
    the calibration is that of a sentence.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    entries = lexicon.select("topic", "topic_ord", "keyword").where("topic is not null").distinct().orderBy("topic_ord", "topic", "keyword").collect()
    topics = list(dict.fromkeys(r["topic"] for r in entries))
    number = {_plain(t): i for i, t in enumerate(topics)}
    if not topics:
        return docs.sparkSession.createDataFrame([], f"{doc_id} {kind}, topic string, posterior double")
    rows = spread(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(labels).alias("labels"))).where("text is not null")
    split = stored(rows.mapInArrow(_split, f"id {kind}, sentences array<string>, labels array<string>"))
    counted = stored(split.select(F.explode("sentences").alias("sentence")).groupBy("sentence").agg(F.count("*").alias("n")))
    # About p.labelled rows, chosen by the hash of their id alone: no sort, and no more than those go to the driver.
    labelled = split.where(F.size("labels") > 0)
    share = min(1.0, p.labelled / max(1, labelled.count()))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    sample = labelled.where(place < int(share * (1 << 30))).select("sentences", "labels", (place % 2).alias("half")).collect()
    known = [(r["sentences"], own, r["half"]) for r in sample if (own := {number[x] for x in map(_plain, filter(None, r["labels"])) if x in number})]
    base = _labelled([(s, own) for s, own, half in known if half == 0], entries, topics, number, p)
    model = _Model(base, p)
    for _ in range(p.rounds):
        got = counted.mapInArrow(_expect(model, p), "w int, c int, n double").groupBy("w", "c").agg(F.sum("n").alias("n")).toArrow()
        counts = base.copy()  # the labelled counts stay in every round: they keep words of no subject level
        counts[got["w"].to_numpy(), got["c"].to_numpy()] += got["n"].to_numpy()
        model = _Model(counts, p)
    held_out = [(s, own) for s, own, half in known if half == 1 and (p.fewer or len(s) >= p.sentences)]
    flat = pa.array([s for r, _ in held_out for s in r], pa.string())
    owner = np.repeat(np.arange(len(held_out)), [len(r) for r, _ in held_out])
    best = _kth(model.scores(flat), owner, len(held_out), p)
    truth = np.zeros_like(best)
    for i, (_, own) in enumerate(held_out):
        truth[i, list(own)] = 1
    calibration = _calibrated(best, truth, model.none, p)
    names = docs.sparkSession.createDataFrame(list(enumerate(topics)), "c int, topic string")
    return split.mapInArrow(_assign(model, calibration, p), f"id {kind}, c int, posterior double").join(F.broadcast(names), "c").select(F.col("id").alias(doc_id), "topic", "posterior")


def _labelled(known, entries, topics, number, p: Subjects) -> np.ndarray:
    """Counts of hashed words by subject in labelled documents, each word once, and in the lexicon."""
    counts = np.zeros((p.words, len(topics) + 1))
    word, owner = _numbers(pa.array([" ".join(s) for s, _ in known], pa.string()), p.words)
    word, owner = np.unique(np.stack([word, owner]), axis=1)
    for c in range(len(topics)):
        weight = np.array([1 / len(own) if c in own else 0.0 for _, own in known])
        if len(word):
            counts[:, c] += np.bincount(word, weight[owner], p.words)
    keywords = [(r["keyword"].lower(), number[_plain(r["topic"])]) for r in entries if r["keyword"]]
    if keywords:
        word, owner = _numbers(pa.array([k for k, _ in keywords], pa.string()), p.words)
        np.add.at(counts, (word, np.array([c for _, c in keywords])[owner]), 1)
    return counts
