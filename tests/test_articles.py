import json

import pytest

from sanadflow.__main__ import main
from sanadflow.functions import defaults
from sanadflow.operators.facets import GateError, search_articles
from sanadflow.plans.articles import build_articles, publish_articles
from sanadflow.plans.grading import grade_counts, grade_rows, phrase_cache
from sanadflow.sources import collections

RECORDS = [("bukhari", 1, "b", "n", "Deeds are by intentions, and each has what it intended.", "Sahih", "q1", 0), ("malik", 2, "b", "n", "A weak one.", "Da'if", None, 1)]


def article(*refs):
    sections = [{"heading": "First", "paras": ["Of deeds"], "hadith": [{"ref": r[:2], "from": r[2] if len(r) > 2 else None, "to": None} for r in refs]}, {"heading": "Empty", "paras": None, "hadith": None}]
    return {"id": None, "title": "Title", "chapters": [{"n": 1, "title": "One", "sections": sections}, {"n": 2, "title": "Bare", "sections": None}]}


@pytest.fixture
def records(spark):
    return spark.createDataFrame(RECORDS, "s string, n int, b string, nr string, x string, g string, q string, ord long")


def built(spark, tmp_path, records, **articles):
    for name, value in articles.items():
        (tmp_path / f"{name}.src.json").write_text(json.dumps(value))
    return build_articles(collections.read_articles(spark, str(tmp_path)), records, defaults.collections(spark))


def test_articles_are_published_with_their_quotations(spark, tmp_path, records):
    b = built(spark, tmp_path, records, good=article(["bukhari", "1", "and each"]))
    out = tmp_path / "out"
    out.mkdir()
    assert publish_articles(b, str(out), check=True) == ["good"] and not list(out.iterdir())
    publish_articles(b, str(out))
    (doc,) = json.loads((out / "good.json").read_text())
    assert doc["chapters"][0]["sections"][0]["hadith"][0]["text"] == "…and each has what it intended." and doc["chapters"][0]["sections"][0]["hadith"][0]["src"] == "Sahih al-Bukhari"
    assert doc["chapters"][0]["sections"][1]["hadith"] == [] and doc["chapters"][1]["title"] == "Bare"
    (entry,) = json.loads((out / "manifest.json").read_text())
    assert (entry["chapters"], entry["sections"], entry["narrations"]) == (2, 2, 1)


def test_nothing_is_published_if_a_reference_fails(spark, tmp_path, records):
    b = built(spark, tmp_path, records, good=article(["bukhari", "1"]), bad=article(["malik", "2"], ["bukhari", "9"], ["bukhari", "1", "no such"]))
    with pytest.raises(GateError, match="3 references"):
        publish_articles(b, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists() and {r.place for r in b.errors.collect()} == {'ch1 "One" / First'}
    assert [r.id for r in b.manifest.collect()] == ["good"]
    every = collections.read_articles(spark, str(tmp_path))
    assert search_articles(every, "OF DEEDS").count() == 2 and search_articles(every, "nowhere").count() == 0
    with pytest.raises(FileNotFoundError):
        collections.read_articles(spark, str(tmp_path), "*.none")


def test_phrases_are_asked_once(spark, tmp_path):
    words = "كتاب قلم باب شجرة ماء سماء ارض نهر جبل".split()
    rows = spark.createDataFrame([(i, " ".join(words[i % 3 :])) for i in range(6)] + [(6, "قصير"), (7, None)], "k long, text string")
    asked = []

    def lookup(phrases):
        asked.append(sorted(r[0] for r in phrases.collect()))
        return phrases.selectExpr("phrase", "'v' AS cand", "0L AS ord", f"'{' '.join(words)}' AS text")

    cache = str(tmp_path / "cache")
    first = grade_rows(rows, "k", "text", lookup, cache, limit=2)
    assert {r.id: r.label for r in first.collect()} == {"0": "matched", "1": "matched"}
    every = grade_rows(rows, "k", "text", lookup, cache).collect()
    assert {r.label for r in every if r.id in "012345"} == {"matched"} and {r.label for r in every if r.id in "67"} == {"too short to match"}
    assert len(asked[0]) == 2 and not set(asked[0]) & set(asked[1])
    assert phrase_cache(spark, cache).count() == len(asked[0]) + len(asked[1])
    assert grade_counts(spark.createDataFrame([("a",), ("b",), ("a",)], "label string")).collect()[0].n == 2
    assert grade_rows(rows.limit(0), "k", "text", lookup, str(tmp_path / "other")).count() == 0


def test_default_tables(spark, tmp_path):
    assert defaults.works(spark).count() == 15 and [r.slug for r in defaults.collections(spark).orderBy("ord").collect()][0] == "bukhari"
    (tmp_path / "lexicon.json").write_text(json.dumps({"Water": ["well", "rain"], "Fire": ["ash"]}))
    assert [tuple(r) for r in defaults.read_lexicon(spark, str(tmp_path / "lexicon.json")).collect()] == [("Water", 0, "well"), ("Water", 0, "rain"), ("Fire", 1, "ash")]


def test_biographies_from_a_file(spark, tmp_path):
    (tmp_path / "b.csv").write_text("﻿scholar_indx,name,grade,death_date_hijri,death_date_gregorian,birth_place,death_place,more\n1,A,,007,,,,x\n")
    (r,) = collections.read_biographies(spark, str(tmp_path / "b.csv")).collect()
    assert (r.scholar_indx, r.death_date_hijri) == ("1", "007")


def test_command_line_extracts_and_reports(spark, tmp_path, capsys):
    editions = tmp_path / "in" / "A.Book"
    editions.mkdir(parents=True)
    (editions / "A.Book.Ed1").write_text("#META#Header#End#\n# 1 حدثنا فلان قال قال رسول الله كلمة واحدة في كتاب قديم جدا\n", encoding="utf-8")
    (tmp_path / "works.csv").write_text("fragment,title\nA.Book,A\n")
    (tmp_path / "lexicon.json").write_text("{}" if False else '{"Book": ["كتاب"]}', encoding="utf-8")
    main(["extract", str(tmp_path / "in"), str(tmp_path / "lexicon.json"), str(tmp_path / "out"), "--works", str(tmp_path / "works.csv")])
    assert spark.read.option("header", True).csv(str(tmp_path / "out/rows")).count() == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "out/summary")).first().status == "built"
    with pytest.raises(SystemExit):
        main(["search", "http://localhost", "q", str(tmp_path / "s"), "--delay", "0.1"])
