import json

import pytest
from pyspark.sql import functions as F

from sanadflow.operators import references
from sanadflow.sources import collections, editions


def test_entries_dialects(spark):
    text = "#META# k :: v\n#META# k :: w\n#META#Header#End#\n# 1 a b c d e f\n~~g h\n### | heading\ndropped in numbered dialect\n# ٢ one two three four five six ms0002\n# 3 short one\n"
    sections = "one two three four five six\n### | a b c d e f\nmore PageV01P052\n###\nlast with quite enough words in it\n"
    rows = [("n", text), ("s", sections), ("e", ""), ("z", None)]
    got = {(r.edition, r.dialect, r.ord, r.n, r.text) for r in editions.entries(spark.createDataFrame(rows, "path string, raw string")).collect()}
    assert got == {
        ("n", "numbered", 1, 1, "a b c d e f g h"), ("n", "numbered", 2, 2, "one two three four five six"),
        ("s", "section", 1, 1, "one two three four five six"), ("s", "section", 2, 2, "a b c d e f more"), ("s", "section", 3, 3, "last with quite enough words in it"),
    }
    meta = spark.createDataFrame(rows[:1], "path string, raw string").select(editions.header(F.col("raw")).alias("m")).first().m
    assert meta == {"k": "w"}


def test_catalogue_and_paths(spark):
    listing = [("r/d/Auth/Work/f1", 5), ("r/d/Auth/Work/f2", 7), ("r/d/Auth/Work/x.yml", 9), ("r/d/Other/W/f", 20), ("r/short", 99)]
    df = spark.createDataFrame(listing, "path string, size long")
    assert [tuple(r) for r in editions.catalogue(df).collect()] == [("Other", "W", 20), ("Auth", "Work", 12)]
    assert editions.catalogue(df, contains="aUTH").count() == 1
    ok = spark.createDataFrame([("x/AUTH.Work/file", "Auth.Work"), ("x/auth.work/file.yml", "Auth.Work")], "p string, f string").select(editions.is_edition(F.col("p"), F.col("f")).alias("k")).collect()
    assert [r.k for r in ok] == [True, False]


def test_read_editions_replaces_bad_bytes(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/one").write_bytes("# 1 نص a b c d e\n".encode() + b"\xff\xfe")
    row = editions.read_editions(spark, str(tmp_path)).first()
    assert row.size > 10 and row.raw.startswith("# 1 نص")


def test_best_edition_takes_most_entries(spark):
    many = "".join(f"# {i} a b c d e f\n" for i in range(3))
    rows = [("w", "p1", 900, "none"), ("w", "p2", 10, many), ("w", "p3", 20, many), ("v", "q", 5, None)]
    got = editions.best_edition(spark.createDataFrame(rows, "work string, path string, size int, raw string"))
    assert [tuple(r) for r in got.collect()] == [("w", "p3", 3)]


def test_collections(spark, tmp_path):
    record = lambda n, **k: {"ref_no": n, "book": "B", "narrator": "N", "text": "T", "topics": ["x"], **k}
    (tmp_path / "b.json").write_text(json.dumps({"hadiths": [record(1, also_at=["a:1", "a:2", "a:3", "a:4"], grade="Sahih")]}))
    (tmp_path / "a.json").write_text(json.dumps({"hadiths": [record(5), record(6)]}))
    rows = collections.read_collections(spark, str(tmp_path), ["b", "a"]).orderBy("ord").collect()
    assert [(r.s, r.n) for r in rows] == [("b", 1), ("a", 5), ("a", 6)]
    assert rows[0].also == ["a:1", "a:2", "a:3"] and (rows[1].g, rows[1].q, rows[1].also) == ("No grading source", "", [])
    with pytest.raises(Exception, match="[Pp]ath|exist"):
        collections.read_collections(spark, str(tmp_path), ["b", "c"]).collect()


def test_dataset_round_trip(spark, tmp_path):
    rows = [("k", 2, "b", "n", "متن", ["t"], "Sahih", ["k:1"], "q"), ("k", 1, None, None, None, None, None, None, None)]
    collections.write_json_document(spark.createDataFrame(rows, collections.NARRATION).coalesce(1), str(tmp_path / "d.json"))
    got = collections.read_dataset(spark, str(tmp_path / "d.json")).orderBy("ord").collect()
    assert [tuple(r)[1:] for r in got] == rows and [r.ord for r in got] == [0, 1]


def test_csv_and_json_documents(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"], 'q "u", v'), ("ب", [], "l1\nl2")], "k string, t array<string>, v string").coalesce(1)
    assert collections.write_csv_document(df, str(tmp_path / "o.csv")) == 2
    assert (tmp_path / "o.csv").read_bytes().startswith(b"\xef\xbb\xbfk,t,v")
    back = collections.read_csv(spark, str(tmp_path / "o.csv"), needs=["k"])
    assert [tuple(r) for r in back.orderBy("k").collect()] == [("a", "x; y", 'q "u", v'), ("ب", None, "l1\nl2")]
    with pytest.raises(ValueError, match="no column zz"):
        collections.read_csv(spark, str(tmp_path / "o.csv"), needs=["zz"])
    collections.write_json_document(df, str(tmp_path / "o.json"))
    assert (tmp_path / "o.json").read_text(encoding="utf-8").startswith('[{"k":"a","t":["x","y"]')
    with pytest.raises(ValueError, match="more than 1"):
        collections.write_json_document(df, str(tmp_path / "o.json"), most=1)


def test_verdict_answers_of_all_shapes(spark):
    one = {"hadith": "t", "rawi": "r", "grade": "g"}
    other = {"text": "t2", "narrator": "r2", "degree": "g2", "hadith": ""}
    texts = [json.dumps(x) for x in ({"data": [one]}, {"data": {"hadiths": [other]}}, {"data": {"results": [one]}}, [other, {"rawi": "no text"}], {"data": 3})] + ["broken", None]
    got = collections.read_verdicts(spark.createDataFrame([(x,) for x in texts], "j string"), "j").collect()
    assert sorted((r.text, r.narrator, r.grade_ar, r.book) for r in got) == [("t", "r", "g", "")] * 2 + [("t2", "r2", "g2", "")] * 2


def test_articles(spark, tmp_path):
    quote = lambda n, **k: {"ref": ["k", n], **k}
    doc = {"id": "a", "title": "T", "chapters": [{"n": 1, "title": "c", "sections": [{"heading": "h", "paras": ["p"], "hadith": [quote(1), {"ref": ["k", 2], "from": "x"}]}, {"heading": "i"}]}, {"n": 2, "sections": []}]}
    (tmp_path / "a.src.json").write_text(json.dumps(doc))
    articles = spark.read.schema(collections.ARTICLE).option("multiLine", True).json(str(tmp_path / "*.src.json"))
    assert [(r.chapter, r.section, r.place, r.slug, r.n, r.start) for r in references.article_refs(articles).orderBy("place").collect()] == [(0, 0, 0, "k", 1, None), (0, 0, 1, "k", 2, "x")]
    m = references.manifest(articles).first()
    assert (m.chapters, m.sections, m.narrations) == (2, 2, 2)


def test_stream_grader_looks_phrases_up_once(spark, tmp_path):
    from sanadflow.functions.profiles import LATIN
    from sanadflow.streaming.grader import grade_stream

    asked = []

    def lookup(phrases):
        asked.extend(r.phrase for r in phrases.collect())
        return phrases.select("phrase", F.lit("c1").alias("cand"), F.lit(1).alias("ord"), F.col("phrase").alias("text"))

    paths = [str(tmp_path / x) for x in ("cache", "out", "state")]
    for part in (["one two three four five six seven"], ["one two three four five six seven", "alpha beta gamma delta epsilon zeta eta"]):
        spark.createDataFrame([(i, x) for i, x in enumerate(part)], "id long, x string").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id long, x string").parquet(str(tmp_path / "in"))
        grade_stream(stream, "id", "x", lookup, *paths, profile=LATIN).awaitTermination()
    assert sorted(asked) == ["alpha beta gamma delta epsilon zeta eta", "one two three four five six seven"]
    out = spark.read.option("recursiveFileLookup", True).parquet(paths[1])
    assert sorted((r.label, r.score) for r in out.collect()) == [("matched", "1.00")] * 3


def test_entries_and_best_edition_move_no_text(spark):
    files = spark.createDataFrame([("w", "p1", 9, "# 1 a b c d e f"), ("w", "p2", 8, "### | a b c d e f\n### | a b c d e g")], "work string, path string, size int, raw string")
    assert "Exchange" not in editions.entries(files)._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in editions.best_edition(files)._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window" in x or "Aggregate" in x]
    assert moved and not any("raw" in x for x in moved)
    assert [tuple(r) for r in editions.best_edition(files).collect()] == [("w", "p2", 2)]
