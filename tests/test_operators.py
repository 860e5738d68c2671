import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sanadflow.operators import dedupe, facets, match, people, references, topics
from sanadflow.operators.graph import components
from sanadflow.operators.pairs import expand_pairs
from sanadflow.operators.skew import heavy_keys, key_profile
from sanadflow.plans.layout import CLEANUP, stored


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_expand_pairs(spark):
    members = spark.createDataFrame([("p", 1), ("p", 2), ("p", 3), ("q", 4), ("r", 5)], "c string, id long")
    links = spark.createDataFrame([("p", "p"), ("p", "q")], "c_a string, c_b string")
    assert {tuple(r) for r in expand_pairs(links, members, ["c"]).collect()} == {(1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4)}


def test_key_profile_equals_plain_counting(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot"] * 30 + ["warm"] * 8 + [f"k{i}" for i in range(40)] + [None, ""]), rng.choice("ab"), rng.choice([None, ["x"], ["x", "y", "y"], []])) for _ in range(1500)]
    df = spark.createDataFrame(rows, "k string, s string, t array<string>").withColumn("key", F.lit("clash")).withColumn("heavy", F.lit(0)).withColumn("n", F.lit(0))
    got = {r.k: r for r in key_profile(df, "k", {"s": "s", "t": "t"}, share=0.05).collect()}
    count, s, t = Counter(r[0] for r in rows), defaultdict(Counter), defaultdict(Counter)
    for k, a, b in rows:
        s[k][a] += 1
        t[k].update(b or [])
    assert set(got) == set(count)
    shown = lambda c: "; ".join(f"{v}={n}" for v, n in sorted(c.items()))
    for k, r in got.items():
        assert (r.n_rows, r.s, r.t, r.n_t) == (count[k], shown(s[k]), shown(t[k]), len(t[k]))
    assert got["hot"].heavy and not got["k1"].heavy


def test_heavy_keys_are_exact_at_the_limit(spark):
    df = spark.createDataFrame([("a",)] * 2 + [("b",)] * 1 + [(f"x{i}",) for i in range(97)] + [(None,)] * 50, "k string")
    assert [tuple(r) for r in heavy_keys(df, "k", 0.02).collect()] == [("a", 2, 100)]
    assert heavy_keys(df.limit(0), "k", 0.02).count() == 0
    with pytest.raises(ValueError):
        heavy_keys(df, "k", 0)


def greedy(sets, p=dedupe.Merge()):
    df = Counter(w for s in sets.values() for w in s)
    kept, state, index = [], {}, defaultdict(set)
    for i in sorted(sets):
        s = sets[i]
        if len(s) < p.shortest:
            state[i] = ("short", None)
            continue
        rare = sorted((w for w in s if df[w] <= p.common), key=lambda w: (df[w], w))[: p.rare]
        found = None
        for j in sorted({j for w in rare for j in index[w]}):
            both = len(s & sets[j])
            jac, cov = both / len(s | sets[j]), both / min(len(s), len(sets[j]))
            if jac >= p.similar or (cov >= p.covered and jac >= p.covered_similar):
                found = j
                break
        if found is None:
            kept.append(i)
            state[i] = ("kept", i)
            for w in rare:
                index[w].add(i)
        else:
            state[i] = ("merged", found)
    return state


@pytest.mark.parametrize("seed", range(4))
def test_merge_equals_sequential_greedy(spark, seed):
    rng = random.Random(seed)
    sets = {}
    for i in range(120):
        base = sets[rng.choice(list(sets))] if sets and rng.random() < 0.6 else None
        s = set(base) if base else {f"w{rng.randrange(70)}" for _ in range(rng.randrange(3, 12))}
        for _ in range(rng.randrange(4)):
            s.discard(rng.choice(sorted(s)) if s else "")
            s.add(f"w{rng.randrange(70)}")
        sets[i] = s
    df = spark.createDataFrame([(None if seed == 3 else "c", i, sorted(s)) for i, s in sets.items()], "scope string, ord long, tokens array<string>")
    got = {r.ord: (r.status, r.kept) for r in dedupe.merge_duplicates(df).collect()}
    assert got == greedy(sets)


def test_merge_is_not_transitive_and_drops_short(spark):
    a, b, c = "a b c d e f g h".split(), "c d e f g h i j".split(), "e f g h i j k l".split()
    df = spark.createDataFrame([("s", 1, a), ("s", 2, b), ("s", 3, c), ("s", 4, ["x"] * 4), ("s", 5, None)], "scope string, ord long, tokens array<string>")
    states = dedupe.merge_duplicates(df)
    assert {(r.ord, r.status) for r in states.collect()} == {(1, "kept"), (2, "merged"), (3, "kept"), (4, "short"), (5, "short")}
    assert {(r.ord, r.dups, tuple(r.members)) for r in dedupe.kept_records(states).collect()} == {(1, 1, (2,)), (3, 0, ())}


def test_merge_does_not_depend_on_partitions(spark):
    rng = random.Random(9)
    rows = [("s", i, [f"w{rng.randrange(40)}" for _ in range(9)]) for i in range(80)]
    df = spark.createDataFrame(rows, "scope string, ord long, tokens array<string>").withColumn("tokens", F.array_distinct("tokens"))
    seen = []
    for n in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(sorted(map(tuple, dedupe.merge_duplicates(df.repartition(int(n))).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1]


LEXICON = [("Prayer", 0, "prayer"), ("Prayer", 0, "bowing"), ("Prayer", 0, "rowing"), ("Journeys", 1, "travel"), ("Neighbours", 2, "neighbour"), ("Neighbours", 2, None)]


@pytest.mark.parametrize(("tokens", "expected"), [(["prayer", "bowing"], ["Prayer"]), (["neighbour"], ["Neighbours"]), (["travels"], ["Journeys"]), (["other"], ["Other Narrations"]), ([], ["Other Narrations"]), (["prayer", "travel"], ["Prayer", "Journeys"])])
def test_topics(spark, tokens, expected):
    sets = spark.createDataFrame([(1, tokens)], "ord long, tokens array<string>")
    lexicon = spark.createDataFrame(LEXICON, "topic string, topic_ord int, keyword string")
    assert topics.assign_topics(sets, lexicon).first().topics == expected


def test_match_labels(spark):
    rows = spark.createDataFrame([("a", "p", list("abcdefghij")), ("b", "p", list("abc")), ("c", "q", list("abcdefgh"))], "id string, phrase string, tokens array<string>")
    cands = spark.createDataFrame([("k1", 1, "p", list("abcdexyz")), ("k2", 2, "p", list("abcdexyz"))], "cand string, ord long, phrase string, tokens array<string>")
    got = {r.id: (r.label, r.match, r.score) for r in match.graded(rows, cands).collect()}
    assert got == {"a": ("matched", "k1", "0.56"), "b": ("too short to match", None, None), "c": ("no confident match", None, "0.00")}


def test_best_in_corpus_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.sample("abcdefghijklmnop", rng.randrange(2, 12))) for i in range(30)]
    texts = [(1000 - i, i, rng.sample("abcdefghijklmnopqrstuvw", rng.randrange(0, 15))) for i in range(700)] + [(2000 + i, 2000 + i, rows[7][1]) for i in range(600)]
    frame = spark.createDataFrame(texts, "cand long, ord long, tokens array<string>").repartition(3)
    got = {r.id: (r.label, r.match, r.score) for r in match.best_in_corpus(spark.createDataFrame(rows, "id long, tokens array<string>"), frame, block=11).collect()}

    def score(a, b):
        both = len(set(a) & set(b))
        return both and max(both / (len(a) + len(b) - both), both / min(len(a), len(b)) * 0.9)

    for i, words in rows:
        s, _, cand = min((-score(words, x), order, cand) for cand, order, x in texts)
        expected = ("too short to match", None, None) if len(words) < 4 else ("matched", cand, -s) if -s >= 0.45 else ("no confident match", None, -s)
        assert got[i] == expected


def test_best_in_corpus_of_common_words(spark):
    rows = spark.createDataFrame([(1, list("abcdefgh")), (2, list("stuvwxyz"))], "id long, tokens array<string>")
    texts = [(i, i, list("abcdefgh")) for i in range(501)]
    got = {r.id: (r.label, r.match, r.score) for r in match.best_in_corpus(rows, spark.createDataFrame(texts, "cand long, ord long, tokens array<string>")).collect()}
    assert got == {1: ("matched", 0, 1.0), 2: ("no confident match", None, 0.0)}


def test_phrase_stands_anywhere(spark):
    texts = {1: "a b c d e f g", 2: "x a b c d e f g", 3: "x y a b c d e f gg", 4: "short one of five words", 5: "so it is a short one of five words here", 6: "a b c d e f g a b c d e f g", 7: ""}
    frame = spark.createDataFrame([(i, i, x.split(" "), sorted(set(x.split(" ")))) for i, x in texts.items()], "cand long, ord long, words array<string>, tokens array<string>")
    phrases = spark.createDataFrame([("a b c d e f g",), ("short one of five words",), ("",), ("b a",)], "phrase string")
    got = sorted((r.phrase, r.cand) for r in match.holding(phrases, frame).collect())
    assert got == [("a b c d e f g", 1), ("a b c d e f g", 2), ("a b c d e f g", 6), ("short one of five words", 4), ("short one of five words", 5)]


def test_best_match_of_equal_rows_and_candidates(spark):
    rows = spark.createDataFrame([("a", "p", list("abcdef")), ("b", "p", list("abcdef")), ("c", "q", list("abcdef"))], "id string, phrase string, tokens array<string>")
    cands = spark.createDataFrame([("k3", 3, "p", list("abcdef")), ("k2", 2, "p", list("abcdef")), ("k1", 1, "p", list("abcdeg")), ("k4", 4, "q", list("abcdeg"))], "cand string, ord long, phrase string, tokens array<string>")
    got = {r.id: (r.label, r.match, r.score) for r in match.graded(rows, cands).collect()}
    assert got == {"a": ("matched", "k2", "1.00"), "b": ("matched", "k2", "1.00"), "c": ("matched", "k4", "0.75")}


@pytest.mark.parametrize(
    ("sizes", "finals"),
    [
        ({"anas ibn malik": 100, "anas": 40}, {"anas": "anas ibn malik"}),
        ({"jabir": 50, "jabir ibn abd allah": 30, "jabir ibn samura": 25}, {}),
        ({"ibn abbas": 40, "abd allah ibn abbas": 60}, {"ibn abbas": "abd allah ibn abbas"}),
        ({"ayyub": 10, "abu ayyub": 50}, {}),
        ({"anas": 100, "anas ibn malik": 30}, {}),
    ],
)
def test_short_forms(spark, sizes, finals):
    keys = spark.createDataFrame([(k, n, i) for i, (k, n) in enumerate(sizes.items())], "key string, n long, first_ord long")
    got = {r.key: r.final for r in people.merge_short_forms(keys).collect()}
    assert got == {k: finals.get(k, k) for k in sizes}


BIO = "scholar_indx string, name string, grade string, death_date_hijri string, death_date_gregorian string, birth_place string, death_place string"


def test_biography_refusals(spark):
    bios = people.biographies(spark.createDataFrame(
        [("1", "Aisha bint Abi Bakr", "Comp.", "57", None, None, None), ("2", "Zayd ibn Ali", "Succ", "73", None, None, None), ("3", "Zayd ibn Ali", "Succ", "84", None, None, None),
         ("4", "Salma ibn Umar", "Companion", "190", None, None, None), ("5", "Harith ibn Badr", "Companion", "12", None, None, None), ("6", "Anas ibn Malik ( انس بن مالك (", "Companion", "93", "712", "-", "Basra")], BIO))
    keys = spark.createDataFrame([(k,) for k in ("aisha", "zayd ibn ali", "salma ibn umar", "harith ibn badr", "anas ibn malik", "nobody known")], "key string")
    got = {r.key: r for r in people.pick_biography(keys, bios).collect()}
    assert {k: r.reason for k, r in got.items()} == {
        "aisha": "name too generic to identify one person", "zayd ibn ali": "2 candidates disagree on the death year", "salma ibn umar": "death 190 AH contradicts 'Companion' (11-110)",
        "harith ibn badr": "death 12 AH too early for a prolific narrator", "anas ibn malik": None, "nobody known": "not in the biography source",
    }
    a = got["anas ibn malik"]
    assert (a.death_h, a.death_g, a.birth_place, a.death_place, a.ar) == (93, 712, "", "Basra", "انس بن مالك")


def test_unique_prefix(spark):
    frame = lambda *k: spark.createDataFrame([(x,) for x in k], "key string")
    got = {r.key: (r.match, r.matches) for r in people.unique_prefix(frame("a", "a b", "c", "d"), frame("a b", "a c", "c d e", "c d e")).collect()}
    assert got == {"a": (None, 2), "a b": ("a b", 1), "c": ("c d e", 1), "d": (None, 0)}


RECORDS = [("k", 1, "the old   text", "B", "Sahih", "ph", 1), ("k", 1, "the new text here", "B", "Sahih", None, 2), ("k", 2, "weak text", "B", "Da'if", "", 3), ("k", 3, "x y", "B", None, "", 4)]


def test_references(spark):
    records = spark.createDataFrame(RECORDS, "s string, n int, x string, b string, g string, q string, ord long")
    refs = spark.createDataFrame([(1, "k", 1, "new", "text"), (2, "k", 1, "old", None), (3, "k", 2, None, None), (4, "k", 9, None, None), (5, "k", 3, None, None)], "id long, slug string, n int, start string, end string")
    titles = spark.createDataFrame([("k", "The K")], "slug string, title string")
    got = {r.id: r for r in references.resolve(refs, records, titles).collect()}
    assert (got[1].text, got[1].src, got[1].verify, got[1].error) == ("…new text…", "The K", "", None)
    assert got[2].error == 'k no.1 has no passage starting "old"' and got[2].text is None
    assert got[3].error == 'k no.2 is graded "Da\'if", not Sahih'
    assert got[4].error == "k no.9 is not in the dataset"
    assert got[5].error == 'k no.3 is graded "", not Sahih'


def test_facets_and_gates(spark):
    df = spark.createDataFrame([(1, "a", "Sahih", ["T"], "x Y"), (2, "a", "Hasan Sahih", None, None), (3, "b", "Da'if", ["T", "T"], "z"), (4, "b", None, [], "y")], "ord long, s string, g string, t array<string>, x string").withColumn("b", F.lit(None).cast("string")).withColumn("nr", F.lit("n"))
    ids = lambda **k: sorted(r.ord for r in facets.facet_filter(df, **k).collect())
    assert ids(grade="sahih") == [1] and ids(grade="hasan") == [1, 2] and ids(grade="weak") == [3] and ids() == [1, 2, 3, 4]
    assert ids(query="Y") == [1, 4] and ids(topic="T") == [1, 3] and ids(collections=["b"]) == [3, 4]
    assert ids(tier="graded") == [1, 2, 3] and ids(tier="ungraded") == [4] and ids(tier="ungraded", grade="sahih") == []
    assert [r.ord for r in facets.page(df, 1, 3).collect()] == [4]
    assert facets.rows_from(df, 1, 0).count() == 0 and facets.rows_from(df, 1).count() == 3
    assert {(r.facet, r.value, r.n) for r in facets.facet_counts(df).collect()} >= {("topic", "T", 2), ("grade", None, 1), ("collection", "a", 2)}
    assert facets.gate(df, facets.is_weak(F.col("g")) & (F.col("s") == "a"), "weak in a") is df
    with pytest.raises(facets.GateError, match="1 rows"):
        facets.gate(df, facets.is_weak(F.col("g")), "weak")
    report = facets.expectations(spark.createDataFrame([("n", 9.0)], "name string, value double"), spark.createDataFrame([("n", 10.0, 0.1), ("m", 1.0, 0.5)], "name string, expected double, tolerance double"))
    assert {r.name: r.ok for r in report.collect()} == {"n": True, "m": False}


def test_a_long_chain_of_duplicates_settles(spark):
    rows = [(scope, i, [f"w{4 * i + k}" for k in range(16)]) for scope in ("s", None) for i in range(400)]
    got = {(r.scope, r.ord): r.status for r in dedupe.merge_duplicates(spark.createDataFrame(rows, "scope string, ord long, tokens array<string>")).collect()}
    # Each record is similar to its two neighbours alone: every other one is kept.
    assert got == {(s, i): "merged" if i % 2 else "kept" for s, i, _ in rows}
    assert got == {(r.scope, r.ord): r.status for r in dedupe.merge_duplicates(spark.createDataFrame(rows[:12], "scope string, ord long, tokens array<string>"), group=0).collect()} | {k: v for k, v in got.items() if k[0] is None or k[1] >= 12}


def test_short_forms_in_rounds_equal_those_in_one_task(spark):
    rng = random.Random(5)
    words = ["muhammad", "ali", "hasan", "umar", "salim", "zayd"]
    keys = {" ibn ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))) for _ in range(150)} | {f"ibn {w}" for w in words}
    df = spark.createDataFrame([(k, rng.randrange(1, 60), i) for i, k in enumerate(sorted(keys))], "key string, n long, first_ord long")
    found = [sorted(map(tuple, people.merge_short_forms(df, group).collect())) for group in (100_000, 3, 0)]
    assert found[0] == found[1] == found[2] and any(a != b for a, b in found[0])


def test_a_common_phrase_is_compared_in_parts(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    rows = spark.createDataFrame([(i, "p" if i % 9 else "q", rng.sample(words, 8)) for i in range(60)], "id long, phrase string, tokens array<string>")
    cands = spark.createDataFrame([(i, i, "p" if i % 5 else "q", rng.sample(words, 8)) for i in range(40)], "cand long, ord long, phrase string, tokens array<string>")
    whole, parts = (sorted(map(tuple, match.best_match(rows, cands, "phrase", at_once=n).collect())) for n in (1_000_000, 50))
    assert whole == parts and any(r[1] == "matched" for r in whole)


def test_a_stored_table_leaves_no_shuffle_behind(spark):
    files = lambda: {f.getPath() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    before = files()
    made = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert made.count() == 7 and spark.conf.get(CLEANUP, None) != "true"


def test_equal_records_are_compared_once(spark, monkeypatch):
    words = [f"word{i:02d}" for i in range(9)]
    rows = [(s, i, words) for s in ("a", None) for i in range(40)] + [(s, 40, [*words[:8], "other"]) for s in ("a", None)] + [("a", 41, words[:4])]
    kept = []

    def keeping(df):
        kept.append(stored(df))
        return kept[-1]

    monkeypatch.setattr(dedupe, "stored", keeping)
    sets = spark.createDataFrame(rows, "scope string, ord long, tokens array<string>")
    edges = {(r["scope"], r["a"], r["b"], round(r["jaccard"], 6)) for r in dedupe.duplicate_edges(sets).collect()}
    expected = {(s, a, b, 1.0 if b < 40 else 0.8) for s in ("a", None) for a in range(40) for b in range(a + 1, 41)}
    assert edges == expected
    pairs = [x for x in kept if x.columns == ["scope", "a", "b"]]
    assert len(pairs) == 1 and pairs[0].count() == 2


def test_marks_never_exclude_a_similar_pair(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [("s", i, sorted(rng.sample(vocabulary, rng.randint(5, 40)))) for i in range(120)]
    found = {(r["a"], r["b"]) for r in dedupe.duplicate_edges(spark.createDataFrame(rows, "scope string, ord long, tokens array<string>"), dedupe.Merge(rare=40)).collect()}
    sets = [set(t) for _, _, t in rows]
    similar = lambda x, y: len(x & y) / len(x | y) >= 0.48 or len(x & y) / min(len(x), len(y)) >= 0.72 and len(x & y) / len(x | y) >= 0.35
    assert found == {(a, b) for a in range(120) for b in range(a + 1, 120) if similar(sets[a], sets[b])}


def test_pairs_that_fail_both_rules_are_sifted_by_their_marks(spark, monkeypatch):
    shared = [f"both{i}" for i in range(8)]
    # Similarity 0.40, coverage 0.57: enough for neither rule.
    rows = [("s", 1, sorted([*shared, *(f"left{i}" for i in range(6))])), ("s", 2, sorted([*shared, *(f"right{i}" for i in range(6))]))]
    kept = []

    def keeping(df):
        kept.append(stored(df))
        return kept[-1]

    monkeypatch.setattr(dedupe, "stored", keeping)
    assert dedupe.duplicate_edges(spark.createDataFrame(rows, "scope string, ord long, tokens array<string>"), dedupe.Merge(rare=40)).isEmpty()
    assert [x.count() for x in kept if x.columns == ["scope", "a", "b"]] == [0]


def test_merge_leaves_no_tables_of_its_pairs(spark, monkeypatch):
    left = []

    def keeping(df):
        left.append(stored(df))
        return left[-1]

    monkeypatch.setattr(dedupe, "stored", keeping)
    words = [f"word{i}" for i in range(9)]
    sets = spark.createDataFrame([("s", i, words) for i in range(3)], "scope string, ord long, tokens array<string>")
    assert {(r.ord, r.status) for r in dedupe.merge_duplicates(sets).collect()} == {(0, "kept"), (1, "merged"), (2, "merged")}
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    gone = [x.columns for x in left if not (at := folder(x.inputFiles()[0])).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)]
    assert ["scope", "h1", "h2", "ord", "tokens", "many"] in gone and ["scope", "ord", "tokens"] not in gone


def test_only_windows_that_may_be_asked_for_are_moved(spark):
    each = spark.range(200).select(F.col("id").cast("string").alias("cand"), F.transform(F.sequence(F.lit(1), F.lit(50)), lambda i: F.xxhash64("id", i)).alias("h"))
    each = each.unionByName(spark.createDataFrame([("empty", []), ("null", None)], "cand string, h array<long>"))
    asked = spark.createDataFrame([(i,) for i in range(0, 200, 2)], "id long").select(F.xxhash64("id", F.lit(7)).alias("h"))
    got = match.sifted(each, asked)
    assert got.join(asked, "h").count() == 100 and got.count() < 110
    assert match.sifted(each, asked.where("false")).isEmpty()


def every_pair(sets, p=dedupe.EVERY):
    kept, state = [], {}
    for i in sorted(sets):
        s = sets[i]
        like = lambda t: (both := len(s & t)) / len(s | t) >= p.similar or both / min(len(s), len(t)) >= p.covered and both / len(s | t) >= p.covered_similar  # noqa: B023, E731
        found = None if len(s) < p.shortest else next((j for j in kept if like(sets[j])), i)
        state[i] = ("short", None) if found is None else ("kept" if found == i else "merged", found)
        if found == i:
            kept.append(i)
    return state


@pytest.mark.parametrize("seed", range(3))
def test_a_merge_of_every_pair_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    sets = {}
    for i in range(150):
        # Copies of earlier records, with own rare words, so that what they share is never among the rarest.
        base = sets[rng.choice(list(sets))] if sets and rng.random() < 0.7 else {f"w{rng.randrange(300)}" for _ in range(rng.choice([3, 12, 40, 400]))}
        sets[i] = {w for w in base if rng.random() < rng.choice([0.5, 0.8, 1])} | {f"own{i}.{k}" for k in range(rng.choice([0, 0, 7]))}
    rows = [(None if seed == 2 else "c", i, sorted(s)) for i, s in sets.items()] + [("other", i, sorted(s)) for i, s in sets.items() if i > 100]
    df = spark.createDataFrame(rows, "scope string, ord long, tokens array<string>")
    got = {(r.scope, r.ord): (r.status, r.kept) for r in dedupe.merge_duplicates(df, dedupe.EVERY).collect()}
    whole, part = every_pair(sets), every_pair({i: s for i, s in sets.items() if i > 100})
    assert got == {(rows[0][0], i): v for i, v in whole.items()} | {("other", i): v for i, v in part.items()}
    assert whole != greedy(sets)
    edges = {(r["scope"], r["a"], r["b"]) for r in dedupe.duplicate_edges(df, dedupe.EVERY).collect()}
    p, long = dedupe.EVERY, [i for i in sets if len(sets[i]) >= 5]
    both = lambda a, b: len(sets[a] & sets[b])
    like = lambda a, b: (j := both(a, b) / len(sets[a] | sets[b])) >= p.similar or j >= p.covered_similar and both(a, b) / min(len(sets[a]), len(sets[b])) >= p.covered
    expected = {(a, b) for a in long for b in long if a < b and like(a, b)}
    assert edges == {(rows[0][0], *x) for x in expected} | {("other", *x) for x in expected if x[0] > 100}
    classes = dedupe._classes(dedupe._keyed(df.where("scope is null or scope <> 'other'"), p))
    few = {(r["a"], r["b"]) for r in dedupe._possible_pairs(classes, p, 40).collect()}
    assert few == {(r["a"], r["b"]) for r in dedupe._possible_pairs(classes, p).collect()}
    # Equal sets are one class: by its first record.
    assert few >= {(a, b) for a, b in expected if min(i for i in sets if sets[i] == sets[a]) == a and min(i for i in sets if sets[i] == sets[b]) == b and sets[a] != sets[b]}


def test_every_pair_of_nothing(spark):
    assert dedupe.merge_duplicates(spark.createDataFrame([], "scope string, ord long, tokens array<string>"), dedupe.EVERY).isEmpty()
    assert [tuple(r) for r in dedupe.merge_duplicates(spark.createDataFrame([("s", 1, ["a"]), ("s", 2, None)], "scope string, ord long, tokens array<string>"), dedupe.EVERY).orderBy("ord").collect()] == [("s", 1, "short", None), ("s", 2, "short", None)]


def test_rows_are_graded_in_parts_of_their_phrases(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)]
    phrase = [None, "", *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))]
    rows = spark.createDataFrame([(i, rng.choice(phrase), rng.sample(words, rng.choice([3, 6, 8]))) for i in range(60)], "id long, phrase string, tokens array<string>")
    texts = spark.createDataFrame([(i, i, w := rng.choices(words, k=25), sorted(set(w))) for i in range(200)], "cand long, ord long, words array<string>, tokens array<string>")
    whole = sorted(map(tuple, match.graded(rows, match.holding(rows.where("size(tokens) >= 4"), texts)).collect()))
    kept = []

    def keeping(df):
        kept.append(stored(df))
        return kept[-1]

    monkeypatch.setattr(match, "stored", keeping)
    assert sorted(map(tuple, match.graded_by_phrase(rows, texts, at_once=1).collect())) == whole and any(r[1] == "matched" for r in whole)
    assert len([x for x in kept if x.columns == ["id", "label", "match", "score"]]) > 1
