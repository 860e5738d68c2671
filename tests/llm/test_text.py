import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sanadflow.llm import leaks, neardup, textform
from sanadflow.llm.words import words_of
from sanadflow.plans import layout

SAME = [("ﬁle", "file"), ("ａｂ１", "ab1"), ("é", "é"), ("a b", "a b"), ("a​b", "ab"), ("сор", "cop"), ("ﻻ", "لا"), ("یك", "يك"), ("soft­hyphen", "softhyphen"), ("Ｏ", "O")]
OTHER = [("a", "A"), ("a", "ā"), ("x²", "x2"), ("قل", "قُل"), ("a b", "ab"), ("½", "1⁄2"), ("ى", "ي"), ("…", "..."), ("", " "), ("a", "a.")]


@pytest.mark.parametrize(("a", "b"), SAME)
def test_same_look(a, b):
    assert textform.look(a) == textform.look(b) and textform.canonical(a) == textform.canonical(b)


@pytest.mark.parametrize(("a", "b"), OTHER)
def test_other_look(a, b):
    assert textform.look(a) != textform.look(b)


def test_forms_are_idempotent():
    rng = random.Random(3)
    for _ in range(3000):
        x = "".join(chr(rng.choice([rng.randrange(32, 0x700), rng.randrange(0x2000, 0x2070), rng.randrange(0xFB00, 0xFFEF), 0x41E, 0x301])) for _ in range(8))
        for f in (textform.look, textform.canonical):
            assert f(f(x)) == f(x), (f, x.encode("unicode-escape"))


def test_forms_columns(spark):
    df = spark.createDataFrame([(1, "Ａ  B"), (2, None), (3, ""), (4, "plain")], "id long, x string").withColumn("look", F.lit("old"))
    got = {r.id: (r.look, r.canonical) for r in textform.with_forms(df, "x").collect()}
    assert got == {1: ("A  B", "a b"), 2: (None, None), 3: ("", ""), 4: ("plain", "plain")}


def test_same_look_pairs(spark):
    rows = [(1, "file"), (2, "ﬁle"), (3, "ﬁle"), (4, "File"), (5, None), (6, ""), (7, "file"), (8, "fi​le")]
    got = {tuple(r) for r in textform.same_look_pairs(spark.createDataFrame(rows, "k long, x string").withColumn("id", F.lit(0)), "k", "x").collect()}
    assert got == {(1, 2), (1, 3), (1, 8), (2, 7), (3, 7), (2, 8), (3, 8), (7, 8)}
    assert textform.same_look_pairs(spark.createDataFrame([], "k long, x string"), "k", "x").count() == 0


def test_groups_hold_the_pairs(spark):
    rows = [(1, "file"), (2, "ﬁle"), (3, "ﬁle"), (4, "File"), (5, None), (6, ""), (7, "file"), (8, "fi\u200ble")]
    df = spark.createDataFrame(rows, "k long, x string")
    groups = {r.id: r for r in textform.look_groups(df, "k", "x").collect()}
    pairs = {(a, b) for a in groups for b in groups if a < b and groups[a].look_id == groups[b].look_id and groups[a].form_id != groups[b].form_id}
    assert pairs == {tuple(r) for r in textform.same_look_pairs(df, "k", "x").collect()} and groups[1].forms == 3 and groups[4].forms == 1 and 5 not in groups


def test_words():
    assert words_of("Al-Bāb, ﬁn. إِلى") == ["al", "bāb".replace("ā", "ā"), "fin", "الي"] and words_of(None) == [] and words_of(" .") == []


def test_signatures_estimate_similarity():
    p, rng = neardup.MinHash(bands=120, rows=7), np.random.default_rng(0)
    for share in (0.3, 0.6, 0.9):
        errors = []
        for _ in range(20):
            both = rng.integers(-(2**62), 2**62, 90)
            n = int(share * 60)
            a, b = both[:60], np.concatenate([both[:n], both[60 : 120 - n]])
            sig = neardup.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), p)
            errors.append((sig[0] == sig[1]).mean() - n / (len(a) + len(b) - n))
        assert abs(np.mean(errors)) < 0.02


@pytest.mark.parametrize("seed", range(2))
def test_similar_pairs_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = []
    for i in range(150):
        words = list(rng.choice(texts)[1].split()) if texts and rng.random() < 0.5 else [f"w{rng.randrange(400)}" for _ in range(30)]
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(999)}"
        texts.append((i, " ".join(words)))
    texts += [(900, None), (901, ""), (902, " . "), (903, texts[0][1]), (904, texts[0][1].upper())]
    sets = {i: set(words_of(x)) for i, x in texts}
    truth = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.6}
    df = spark.createDataFrame(texts, "entry long, x string").withColumn("id", F.lit("clash"))
    got = {tuple(r) for r in neardup.similar_pairs(df, "entry", "x").collect()}
    assert got <= truth and len(got) >= 0.98 * len(truth)
    assert got <= {tuple(r) for r in neardup.similar_pairs(df, "entry", "x", neardup.MinHash(max_bits=None)).collect()} <= truth
    groups = neardup.similar_groups(df, "entry", "x").collect()
    assert len({r.id for r in groups}) == len(groups) == sum(map(bool, sets.values()))


def test_shingles_of_five_words():
    words = pa.array("a b c d e f x y".split())
    sets, ends = neardup.shingle_sets(words, np.array([0, 6, 8, 8]))
    assert list(np.diff(ends)) == [2, 1, 0] and len(set(sets)) == 3


def test_fm_index_finds_all():
    rng = np.random.default_rng(1)
    text = np.concatenate([rng.integers(1, 5, 300), [0]]).astype(np.int64)
    index = leaks.FMIndex(text, 9)
    phrases = np.array([rng.integers(1, 5, 3) for _ in range(40)] + [[7, 1, 2], [1, 2, 8]])
    low, high = index.search(phrases)
    for q, a, b in zip(phrases, low, high, strict=True):
        places = sorted(i for i in range(len(text) - 2) if (text[i : i + 3] == q).all())
        assert sorted(index.locate(np.arange(a, b))) == places


def test_leaks(spark):
    rng = random.Random(2)
    item = [f"i{rng.randrange(5000)}" for _ in range(50)]
    noise = lambda n: [f"n{rng.randrange(3000)}" for _ in range(n)]
    changed = item[:30]
    changed[9] = "other"
    docs = [
        (1, noise(20) + item + noise(20)), (2, noise(10) + changed + noise(9)), (3, noise(30) + item[:12] + noise(30)), (4, item[:11] + noise(8) + item[30:42]), (5, item[30:42] + noise(8) + item[:11]),
        (6, noise(80)), (7, [w.upper() for w in item[5:30]]),
    ]
    rows = [(i, ", ".join(x)) for i, x in docs] + [(8, None), (9, "")]
    items = spark.createDataFrame([(77, " ".join(item)), (78, "too short"), (79, None)], "item_id long, text string")
    got = {r.doc_id: r for r in leaks.leaks(spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(0)), "doc_id", "text", items, "item_id", "text").collect()}
    assert set(got) == {1, 2, 4, 5, 7} and all(r.item_id == 77 for r in got.values())
    assert [tuple(s) for s in got[1].spans] == [(20, 70)] and got[1].share == 1.0 and got[2].share == pytest.approx(29 / 50)
    assert leaks.leaks(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", items.limit(0), "item_id", "text").count() == 0
    assert leaks.leaks(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text", items, "item_id", "text").count() == 0


def test_any_number_of_stretches_in_any_order(spark):
    item = [f"i{k}" for k in range(60)]
    pad = lambda n: [f"n{n}x{k}" for k in range(9)]
    docs = {
        "three": sum((pad(k) + item[20 * k : 20 * k + 10] for k in range(3)), []), "swapped": item[35:56] + pad(5) + item[:21], "in order": item[:14] + pad(6) + item[30:44],
        "eight short": sum((pad(k) + item[7 * k : 7 * k + 7] for k in range(8)), []), "verbatim": pad(1) + item[10:32] + pad(2), "too little": pad(1) + item[10:22] + pad(2), "one place twice": pad(3) + item[:12] + pad(4) + item[:12],
    }
    frame = spark.createDataFrame([(k, " - ".join(x)) for k, x in docs.items()], "doc string, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = leaks.leaks(frame, "doc", "text", items, "item_id", "text")
    got = {r.doc: r.share for r in found.collect()}
    assert {k: round(v * 60) for k, v in got.items()} == {"three": 30, "swapped": 42, "in order": 28, "eight short": 56, "verbatim": 22}
    strict = leaks.leaks(frame, "doc", "text", items, "item_id", "text", leaks.Leaks(stretches=2, run=None))
    assert {r.doc for r in strict.collect()} == {"in order"}
    texts = dict(frame.collect())
    for r in leaks.in_characters(frame, "doc", "text", found).collect():
        removed = [words_of(texts[r.doc][s["from"] : s["to"]]) for s in r.spans]
        assert sorted(w for x in removed for w in x if w in item) == sorted(w for w in docs[r.doc] if w in item)


def test_items_in_several_blocks_and_passes(spark):
    items = [[f"i{n}w{k}" for k in range(20)] for n in range(11)]
    frame = spark.createDataFrame([(n, " ".join(["x", *x, "y"])) for n, x in enumerate(items)], "doc long, text string")
    asked = spark.createDataFrame([(str(n), " ".join(x)) for n, x in enumerate(items)], "item string, text string")
    got = {tuple(r[:2]) for r in leaks.leaks(frame, "doc", "text", asked, "item", "text", leaks.Leaks(block=2, items=4)).collect()}
    assert got == {(n, str(n)) for n in range(11)}


def test_a_leak_in_most_documents_is_still_found(spark):
    item = [f"i{k}" for k in range(50)]
    rows = [(i, " ".join([f"n{i}"] + item)) for i in range(40)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert leaks.leaks(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", items, "item_id", "text").count() == 40


@pytest.mark.parametrize("copy", ["same", "other end", "short"])
def test_copies_of_a_short_quotation_make_no_set_phrase(spark, copy):
    item = [f"i{k}" for k in range(50)]
    quote = item[:15] if copy != "short" else item[:7]
    copies = [(100 + i, [f"n{k}" for k in range(20)] + quote + [f"m{k}" for k in range(20)] + [f"e{i}"] * (copy == "other end")) for i in range(30)]
    rows = [(1, item[:15] + [f"o{k}" for k in range(5)] + item[20:28]), *copies]
    if copy == "short":
        rows += [(i + 200, [f"n{k}" for k in range(9)] + item[4:11] + [f"m{k}" for k in range(9)]) for i in range(30)] + [(i + 300, [f"n{k}" for k in range(9)] + item[8:15] + [f"m{k}" for k in range(9)]) for i in range(30)]
    frame = spark.createDataFrame([(i, (" " if i % 2 else ", ").join(x)) for i, x in rows], "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = leaks.leaks(frame, "doc_id", "text", items, "item_id", "text").collect()
    assert [(r.doc_id, [tuple(s) for s in r.spans], r.share) for r in got] == [(1, [(0, 15), (20, 28)], 23 / 50)]


def test_a_set_phrase_between_other_words_is_no_quotation(spark):
    item = [f"i{k}" for k in range(50)]
    rows = [(1, item[:15] + [f"o{k}" for k in range(5)] + item[20:28])] + [(100 + i, [f"n{i}"] * 9 + item[:15] + [f"m{i}"] * 9) for i in range(30)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert leaks.leaks(spark.createDataFrame([(i, " ".join(x)) for i, x in rows], "doc_id long, text string"), "doc_id", "text", items, "item_id", "text").count() == 0


def test_nfc_is_assumed_by_look():
    assert unicodedata.is_normalized("NFC", textform.look("é​"))


def test_very_long_texts(spark):
    rng = random.Random(8)
    item = [f"i{k}" for k in range(50)]
    long = [f"w{rng.randrange(10**6)}" for _ in range(120_000)]
    rows = [(1, " ".join(long + item)), (2, " ".join(long[:110_000] + item)), (3, " ".join(item)), (4, "\u200b".join(long)), (5, "\u200b".join(long) + "\u200b")]
    df = spark.createDataFrame(rows, "id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {r.id for r in leaks.leaks(df, "id", "text", items, "item_id", "text").collect()} == {1, 2, 3}
    assert {tuple(r) for r in neardup.similar_pairs(df, "id", "text").collect()} == {(1, 2), (4, 5)}
    assert [tuple(r) for r in textform.same_look_pairs(df, "id", "text").collect()] == [(4, 5)]


def test_signatures_of_long_sets_equal_those_in_one_go():
    p, rng = neardup.MinHash(bands=3, rows=2), np.random.default_rng(0)
    words, ends = rng.integers(0, 2**62, 200), np.array([0, 3, 120, 125, 200])
    assert (neardup.signatures(words, ends, p) == neardup.signatures(words, ends, p, at_once=10)).all()


def test_bands_move_in_groups_and_marks_lose_no_pair(spark):
    p, rng = neardup.MinHash(bands=5, rows=2), np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) * 0x9E3779B97F4A7C1 for _ in range(60)]
    words, ends = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
    whole = neardup.band_keys(neardup.signatures(words, ends, p), p)
    parts = [neardup.band_keys(neardup.signatures(words, ends, p, first=at * 2, last=(at + n) * 2), p, at) for at, n in ((0, 3), (3, 2))]
    assert (np.concatenate(parts, axis=1) == whole).all()
    rows = np.concatenate([np.diff(ends)[None], neardup.marks(words, ends).T])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert both < 0.6 * (len(a) + len(b) - both) or neardup.possible(rows[:, [i]], rows[:, [j]], 0.6)[0]
    texts = [(i, " ".join(map(str, x % 997))) for i, x in enumerate(sets)]
    texts += [(i + 100, f"{x} 5000") for i, x in texts]
    layout.clear_stored(spark)
    classes = neardup._members(spark.createDataFrame(texts, "id long, text string"), "id", "text", neardup.word_sets, p := neardup.MinHash(bands=70, rows=2))[1]
    once, more = ({(r.c1_a, r.c1_b) for r in neardup.similar_classes(classes, p, at_once=n).collect()} for n in (70, 40))
    assert once == more and once
    # Left are members, sets and both times the parts of the links: neither bands nor candidates.
    assert layout.clear_stored(spark) == 2 + 2 * neardup.PARTS
