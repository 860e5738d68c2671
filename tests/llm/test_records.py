import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sanadflow.llm import languages, mixing, names, people, subjects


@pytest.mark.parametrize(
    ("value", "parts"),
    [
        ("Narrated Ghimshas binkimnikham al-Nuyshaqashi:", ("", "ghimshas", "kimnikham", "nuyshaqashi", "", None)),
        ("al-Filqughifi, Ramzan ibn Tibkuhaf", ("", "ramzan", "tibkuhaf", "filqughifi", "", None)),
        ("Abi Kunrum, Talshil son of Wizmighif, al-Ghimghijaqi", ("kunrum", "talshil", "wizmighif", "ghimghijaqi", "", None)),
        ("Lurshuk bin Quzfadak, known as al-Taffuk (may he be at peace)", ("", "lurshuk", "quzfadak", "", "taffuk", None)),
        ("al-Taffuk bn Quzfadak d. 61 H. said", ("", "", "quzfadak", "", "taffuk", 61)),
        ("B. bn Lurfijut AL-SHAMSHUQIZI [120 AH]", ("", "b", "lurfijut", "shamshuqizi", "", 120)),
        ("Mouykhit ibn B. el-Rambiwaki", ("", "muykhit", "b", "rambiwaki", "", None)),
        ("Wizlān ibn Nasruzuf Al Hazkisazi", ("", "wizlan", "nasruzuf", "hazkisazi", "", None)),
        (None, ("", "", "", "", "", None)), (" ", ("", "", "", "", "", None)), ("Narrated", ("", "", "", "", "", None)),
    ],
)
def test_parse(value, parts):
    assert tuple(names.parse(value)) == parts


@pytest.mark.parametrize(("typed", "year"), [("176.0", 176), ("231 AH", 231), ("c. 77", 77), ("1500", None), ("-", None), (None, None), ("unknown", None), ("87/88", 87), ("١٢٣", 123)])
def test_year(typed, year):
    assert names.year_of(typed) == year


def test_near_shares_a_variant():
    rng = random.Random(0)
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(4, 8)))
        b = list(a)
        i = rng.randrange(len(b) - 1)
        rng.choice([lambda: b.__setitem__(i, "x"), lambda: b.pop(i), lambda: b.insert(i, "x"), lambda: b.__setitem__(slice(i, i + 2), b[i : i + 2][::-1])])()
        b = "".join(b)
        assert names.near(a, b) <= 1 and (len(b) < 4 or set(names.variants(a)) & set(names.variants(b)))


VALUES = ["Narrated Zanrum ibn Ghimquqash al-Qinzutali", "Zanrum bin Ghimquqash", "Z. ibn Ghimquqash al-Qinzutali", "Zanrum al-Qinzutali said", "Zanrum ibn Ghimqquqash al-Qinzutali", "Tibmuq ibn Masjadud al-Ghaytiwini", "Tibmuq bin Masjadud al-Wandinabi", "Tibmuq ibn Masjadud", "Abu", "A man", "", None, "His father"]


@pytest.mark.parametrize("edited", [0, 1])
@pytest.mark.parametrize(("x", "y"), [(x, y) for x in range(5) for y in range(x + 1, 5)])
def test_any_two_whole_parts_with_one_edit_share_a_key(x, y, edited):
    for parts, other in ((("harun", "malik", "salim", "basri", "tawil"), ("harin", "malki", "salm", "basrri", "tawal")), (("anas", "umr", "zay", "adi", "say"), ("ans", "umi", "zya", "ada", "sayy"))):
        a, b = ([""] * 5 for _ in range(2))
        a[x], a[y] = parts[x], parts[y]
        b[x], b[y] = (other[x], parts[y]) if edited else (parts[x], other[y])
        assert set(names.keys(names.Name(*a))) & set(names.keys(names.Name(*b)))


def test_variants_of_names(spark):
    df = spark.createDataFrame([(v,) for v in VALUES * 2], "nr string").withColumn("value", F.lit(1)).withColumn("id", F.lit(2))
    got = {tuple(r) for r in people.same_person_pairs(df, "nr").collect()}
    same = sorted(VALUES[:5])
    assert got == {(a, b) for a in same for b in same if a < b}
    assert people.same_person_pairs(df.limit(0), "nr").count() == 0


def test_names_of_any_form(spark):
    typed = ["John Smith"] * 3 + ["Narrated John Smith", "Jon Smith", "J. Smith", "Smith, John", "Maria Lopez Garcia", "Reported by Maria Lopez Garcia", "Maria Lopes Garcia", "Bill Harrison", "William Harrison", "His father", "A man", "Ann Lee", "An Li"]
    got = {tuple(r) for r in people.same_person_pairs(spark.createDataFrame([(v,) for v in typed], "nr string"), "nr").collect()}
    groups = [["John Smith", "Narrated John Smith", "Jon Smith", "J. Smith", "Smith, John"], ["Maria Lopez Garcia", "Reported by Maria Lopez Garcia", "Maria Lopes Garcia"], ["Bill Harrison", "William Harrison"]]
    assert got == {(a, b) for g in groups for a in g for b in g if a < b}
    members = people.same_person_groups(spark.createDataFrame([(v,) for v in typed], "nr string"), "nr").collect()
    assert {frozenset(r.value for r in members if r.person == p) for p in {r.person for r in members if r["values"] > 1}} == set(map(frozenset, groups))


def test_no_chain_of_neighbours(spark):
    # Each name one edit from the next, all frequent and borne by several families: none is a misspelling.
    given = ["Karim", "Karin", "Kazin", "Kazif"]
    typed = [f"{x}{g} ibn {f} al-Basri" for g in given for f in ("Malik", "Salim", "Yunus", "Hamdan", "Idris") for x in ("", "Narrated ", "Reported by ", "From ")]
    got = {tuple(r) for r in people.same_person_pairs(spark.createDataFrame([(v,) for v in typed], "nr string"), "nr").collect()}
    assert got and all(names.parse(a)[:4] == names.parse(b)[:4] for a, b in got)


def test_match_and_non_match_probabilities_are_estimated():
    rng = random.Random(3)
    counts = {}
    for i in range(20000):
        match = rng.random() < 0.6
        odd = None if match else rng.choice([1, 2, 3])
        pattern = tuple(rng.choices([names.OTHER, names.NEAR, names.EQUAL], [0.95, 0.04, 0.01] if f == odd else [0.005, 0.1, 0.895])[0] if f in (1, 2, 3) and rng.random() < 0.9 else names.MISSING for f in range(6))
        counts.setdefault(pattern, [0, 0])[match] += 1
    odds = people.estimate(sorted((k, sum(v)) for k, v in counts.items()), [(0.01, 0.05)] * 6, people.Linkage())
    right = sum(v[odds[k] > 0] for k, v in counts.items())
    assert right >= 0.995 * sum(max(v) for v in counts.values())
    off = [abs(1 / (1 + 2.718281828 ** -odds[k]) - v[1] / sum(v)) for k, v in counts.items() if sum(v) > 500]
    assert max(off) < 0.2


def test_linked_biographies(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "nr string")
    bios = spark.createDataFrame(
        [("1", "Al-Qinzutali, Zanrum b. Ghimquqash ( زانروم (", "c. 99"), ("2", "Zanrum ibn Ghimquqash", None), ("3", "Salwin ibn Ghimquqash al-Qinzutali", "80"), ("4", "Tibmuq ibn Masjadud al-Ghaytiwini", "137"), ("5", None, "1"), ("6", "Tibmuq bin Masjadud al-Wandinabi", "210")],
        "scholar_indx string, name string, death_date_hijri string",
    )
    got = {(r.value, r.scholar_indx) for r in people.linked(df, "nr", bios, "scholar_indx", "name", "death_date_hijri").collect()}
    assert {("Zanrum bin Ghimquqash", "1"), ("Zanrum bin Ghimquqash", "2"), (VALUES[5], "4"), (VALUES[6], "6"), (VALUES[3], "1")} <= got
    assert not [x for x in got if x[0] == "Tibmuq ibn Masjadud" or x[1] in ("3", "5")]
    assert people.linked(df.limit(0), "nr", bios, "scholar_indx", "name", "death_date_hijri").count() == 0


LEXICON = [("Fire", 0, "flame"), ("Fire", 0, "ash"), ("Rain", 1, "cloud"), ("Rain", 1, "storm")]


def test_subjects(spark):
    rng = random.Random(4)
    sets = {"Fire": "flame ash ember smoke hearth coal".split(), "Rain": "cloud storm puddle thunder drizzle flood".split()}
    rows = []
    for i in range(400):
        about = rng.choice([["Fire"], ["Rain"], ["Fire", "Rain"], []])
        text = [f"We saw the {rng.choice(sets[t])} and then the {rng.choice(sets[t])} there." for t in about for _ in range(2)] + [f"He went on by the {rng.choice(['road', 'wall', 'gate'])} and said nothing more."] * rng.randrange(1, 3)
        if rng.random() < 0.2:
            text.append(f"His patience was like a {rng.choice(sets['Fire'])} that nobody notices.")
        rng.shuffle(text)
        rows.append((i, " ".join(text), rng.choice([about, about, about, None, [x.lower() for x in about], ["Other"]]), about))
    df = spark.createDataFrame([r[:3] for r in rows] + [(900, None, ["Fire"]), (901, "", None)], "row_id long, x string, t array<string>").withColumn("id", F.lit("clash"))
    lexicon = spark.createDataFrame(LEXICON, "topic string, topic_ord int, keyword string")
    got = {(r.row_id, r.topic) for r in subjects.subjects(df, "row_id", "x", "t", lexicon).collect()}
    truth = {(r[0], t) for r in rows for t in r[3]}
    assert len(got & truth) >= 0.95 * len(truth) and len(got & truth) >= 0.95 * len(got)
    assert subjects.subjects(df.limit(0), "row_id", "x", "t", lexicon).count() == 0


def test_rare_telling_words_stay_in_the_model(spark):
    rng = random.Random(6)
    common = ["went", "on", "by", "the", "road", "and", "said", "nothing", "more"]
    words = {"Fire": "flame ash ember smoke".split(), "Rain": "cloud storm puddle thunder".split()}
    rows = []
    for i in range(200):
        about = ["Fire", "Rain"][i % 2] if i % 4 < 2 else None
        text = " ".join(f"He {' '.join(common)} {rng.choice(words[about]) if about else 'then'}." for _ in range(3))
        rows.append((i, text, [about] if about else []))
    df = spark.createDataFrame(rows, "row_id long, x string, t array<string>")
    lexicon = spark.createDataFrame([(t, k, w) for k, t in enumerate(words) for w in words[t]], "topic string, topic_ord int, keyword string")
    got = {(r.row_id, r.topic) for r in subjects.subjects(df, "row_id", "x", "t", lexicon).collect()}
    assert got == {(i, t[0]) for i, _, t in rows if t}


def test_one_sentence_can_be_about_a_subject(spark):
    rng = random.Random(4)
    sets = {"Fire": "flame ash ember smoke hearth coal".split(), "Rain": "cloud storm puddle thunder drizzle flood".split()}
    rows = []
    for i in range(600):
        about = rng.choice(["Fire", "Rain", None])
        words = rng.sample(sets[about], 3) if about else rng.sample(["road", "wall", "gate", "mule"], 3)
        text = [f"{words[0].capitalize()} and {words[1]} came near the {words[2]}."] * (1 if i % 3 else 2)
        rows.append((i, " ".join(text), [about] if about and rng.random() < 0.8 else []))
    rows += [(901, "Ember, ash and coal glowed.", None), (902, "EMBER, ASH AND COAL GLOWED", None)]
    df = spark.createDataFrame(rows, "row_id long, x string, t array<string>")
    lexicon = spark.createDataFrame(LEXICON, "topic string, topic_ord int, keyword string")
    got = {(r.row_id, r.topic) for r in subjects.subjects(df, "row_id", "x", "t", lexicon).collect()}
    truth = {(i, t) for i, x, _ in rows for t, s in sets.items() if any(w in x.lower() for w in s)}
    assert got == truth
    two = {r.row_id for r in subjects.subjects(df, "row_id", "x", "t", lexicon, subjects.Subjects(fewer=False)).collect()}
    assert two == {i for i, _ in truth if i < 900 and i % 3 == 0}


def test_calibration_is_of_each_subject():
    rng = np.random.default_rng(0)
    best = rng.normal(0, 4, (4000, 3)).astype(np.float32)
    cut = np.array([-2.0, 0.0, 3.0])
    truth = (rng.random(best.shape) < 1 / (1 + np.exp(-(best - cut)))).astype(np.float32)
    fitted = subjects._calibrated(best, truth, 5.0, subjects.Subjects())
    assert np.allclose(-fitted[:, 0] / fitted[:, 1], cut, atol=0.5)


def test_label_codes(spark):
    typed = ["EN", "en-GB", "ur_PK", "French", " Persian ", "in", "ms", "nl", "", None, "und", "unknown", "Bahasa Indonesia", "xyz"]
    got = [r.c for r in spark.createDataFrame([(x,) for x in typed], "l string").select(languages.label_code(F.col("l")).alias("c")).collect()]
    assert got == ["en", "en", "ur", "fr", "fa", "id", "ms", "nl", None, None, None, None, "id", "xyz"]


GERMAN = ("der Bauer,die Händlerin,der alte Richter,ein junger Schreiber,das Kind", "brachte,verkaufte,suchte,vergaß,zählte", "das Brot,die Bücher,den Schlüssel,einen langen Brief,das Wasser", "auf dem Markt,am frühen Morgen,vor der großen Mauer,weil es regnete,als die Sonne unterging")


def test_a_language_of_no_list_is_learned_from_its_labels(spark):
    rng = random.Random(1)
    sentence = lambda: " ".join(rng.choice(x.split(",")) for x in GERMAN) + "."
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(90000 + i, " ".join(sentence() for _ in range(5)), rng.choice(["de", "German", "ger", "Deutsch"]), None, 0) for i in range(40)]
    rows += [(91000 + i, f"The judge heard both parties and gave the verdict. {sentence()} The shepherd went home at once.", "en", None, 0) for i in range(5)]
    rows += [(92000 + i, "The judge heard both parties and gave the verdict near the gate.", "xyz", None, 0) for i in range(4)]
    rows += [(93000, "ᐊᐃᓐᓇ ᑕᒪᓐᓇ ᐅᖃᓕᒫᒐᖅ ᐊᑐᖅᑕᐅᔪᖅ ᓄᓇᕗᒻᒥ", None, None, 0)]
    got = languages.mislabelled(docs.unionAll(spark.createDataFrame(rows, docs.schema)), "doc_id", "text", "lang").where("doc_id >= 90000").collect()
    # German documents are right as they stand; the wrong label of English ones makes no language.
    assert {tuple(r) for r in got} == {(91000 + i, x) for i in range(5) for x in ("en", "de")} | {(92000 + i, "en") for i in range(4)} | {(93000, "und")}


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = [(9001, "The judge heard both parties and gave the verdict. On rapporte que le berger a rendu le pain à l'aube.", "en", None, 0), (9002, None, "en", None, 0), (9003, "", None, None, 0), (9004, "12 34 !!", None, None, 0)]
    every = docs.unionAll(spark.createDataFrame(extra, docs.schema))
    model = languages.fit(docs.where("doc_id % 2 = 0"), "text", "lang")
    got = {r.doc_id: r for r in languages.languages(every, "doc_id", "text", "lang", model=model).collect()}
    assert 9002 not in got and got[9003].lang == "und" and got[9004].lang == "und"
    assert {s.lang for s in got[9001].segments} == {"en", "fr"}
    right = [r for r in got.values() if r.label is not None and r.doc_id % 2 and r.doc_id < 9000]
    assert sum(r.label == r.lang for r in right) >= 0.85 * len(right)


def test_very_long_text_in_two_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = "The judge heard both parties and gave the verdict near the old gate. " * 9000 + "On rapporte que le berger a rendu le pain à l'aube."
    every = docs.unionAll(spark.createDataFrame([(9001, text, None, None, 0)], docs.schema))
    got = languages.mislabelled(every, "doc_id", "text", "lang").where("doc_id = 9001").collect()
    assert {r.lang for r in got} == {"en", "fr"}


def plain_sainte_lague(weights, caps, seats):
    out = [0] * len(weights)
    for _ in range(seats):
        free = [i for i in range(len(weights)) if out[i] < caps[i] and weights[i] > 0]
        if not free:
            break
        out[max(free, key=lambda i: (weights[i] / (2 * out[i] + 1), -i))] += 1
    return out


def test_sainte_lague():
    for seed in range(2000):
        rng = random.Random(seed)
        k = rng.randint(1, 7)
        w, c = [rng.choice([0, 1, 2, 3, rng.random()]) for _ in range(k)], [rng.randint(0, 30) for _ in range(k)]
        n = rng.randint(0, 80)
        assert mixing.sainte_lague(w, c, n) == plain_sainte_lague(w, c, n)


def test_mix(spark):
    rng = random.Random(1)
    docs = [(i, rng.choice(["a"] * 8 + ["b"] * 3 + ["c", None, "x"]), " ".join(["word"] * rng.randrange(1, 12))) for i in range(900)] + [(2000, "a", None), (2001, "b", "")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("copies", F.lit(1)).withColumn("block", F.lit(1))
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.5, 2), ("c", 0.15, 3), ("gone", 0.05, 3)], "source string, target_share double, max_repeats int")
    p = mixing.Mixture(block=64, shard=2000, tokens=2500)
    mixed, report = mixing.mix(df, "doc_id", "text", "source", targets, p)
    rows, shares = mixed.collect(), {r.source: r for r in report.collect()}
    caps = {"a": 1, "b": 2, "c": 3}
    assert len({r.doc_id for r in rows}) == len(rows) and all(1 <= r.copies <= caps[r.source] for r in rows)
    assert abs(shares["a"].actual_share / shares["b"].actual_share - 0.6) < 0.05 and shares["gone"].mixed_tokens == 0
    assert abs(sum(r.actual_share for r in shares.values()) - 1) < 1e-9
    # Without a total, the source with the least tokens for its share sets it, and all others reach theirs within a document.
    report = {r.source: r for r in mixing.mix(df, "doc_id", "text", "source", targets, mixing.Mixture(block=16, shard=2000))[1].collect()}
    total = min(report[s].tokens * caps[s] / report[s].target_share for s in caps) * 0.95
    assert [s for s in caps if report[s].capped] == [min(caps, key=lambda s: report[s].tokens * caps[s] / report[s].target_share)]
    assert all(abs(report[s].mixed_tokens - total * report[s].target_share / 0.95) <= 16 + 6 * (report[s].tokens // 2000 + 1) for s in caps)
    assert mixing.mix(df.limit(0), "doc_id", "text", "source", targets)[0].count() == 0
    assert sorted(map(tuple, mixing.mix(df.repartition(7), "doc_id", "text", "source", targets, p)[0].collect())) == sorted(map(tuple, rows))


def test_a_byname_alone_is_the_only_person_who_shows_it(spark):
    told = ["Narrated Nirwud bin Jumjikham, known as al-Takkush", "Abu Zanraz Liszan b. Kaykhuwud al-Hubmusazi d. 150", "Darbat ibn Quzwin al-Basriqi", "Wulshuk ibn Timzan al-Basriqi"]
    alone = ["al-Takkush reported", "Narrated Abu Zanraz", "Abu Zanraz d. 151", "Abu Zanraz d. 300", "Ibn Quzwin", "al-Basriqi", "al-Nowhuri", "Narrated al-Nowhuri", "His father", "Darbat", None, " "]
    df = spark.createDataFrame([(x,) for x in told + alone], "nr string")
    found = {(r.a, r.b) for r in people.same_person_pairs(df, "nr").collect()}
    groups = [[told[0], alone[0]], [told[1], alone[1], alone[2]], [told[2], alone[4]]]
    assert found == {(a, b) for g in groups for a in g for b in g if a < b}


def _broadcast_rows(spark, run):
    """Most rows that were sent to all tasks at once while ``run`` went."""
    sc, store = spark.sparkContext, spark._jsparkSession.sharedState().statusStore()
    executions = lambda: [store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())]
    before = set(executions())
    run()
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    rows = [0]
    for e in set(executions()) - before:
        nodes, seen = store.planGraph(e).allNodes(), store.executionMetrics(e)
        for node in (nodes.apply(i) for i in range(nodes.size())):
            if node.name() == "BroadcastExchange":
                found = [node.metrics().apply(i) for i in range(node.metrics().size())]
                rows += [int(seen.apply(m.accumulatorId()).replace(",", "")) for m in found if m.name() == "number of output rows" and seen.contains(m.accumulatorId())]
    return max(rows)


def _typed_names(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(x) for x in ["bdfgkmnqrstz", "aiu"] * 3)
    words_ = [word() for _ in range(60)]
    return sorted({f"{rng.choice(words_).title()} ibn {rng.choice(words_).title()} al-{rng.choice(words_).title()}" for _ in range(600)})


def test_keys_of_biographies_are_not_gathered_by_the_driver(spark):
    """Stored tables of a few KB have keys of some MB, far over the threshold."""
    typed = _typed_names(spark)
    df, bios = spark.createDataFrame([(v,) for v in typed], "nr string"), spark.createDataFrame([(str(i), v, None) for i, v in enumerate(typed)], "bio string, name string, death string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        # A row has 16 bytes at least.
        assert _broadcast_rows(spark, lambda: people.linked(df, "nr", bios, "bio", "name", "death").collect()) <= 4096
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "64k" and spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_keys_of_names_are_not_gathered_by_the_driver(spark):
    df = spark.createDataFrame([(v,) for v in _typed_names(spark)], "nr string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        assert _broadcast_rows(spark, lambda: people.same_person_pairs(df, "nr").collect()) <= 4096
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
