import pytest
from pyspark.sql import functions as F

from sanadflow.functions import names as N
from sanadflow.functions import text as X
from sanadflow.functions.profiles import CORPUS, VERDICT


def one(spark, f, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("text", "name"),
    [("", "Ungraded"), (None, "Ungraded"), ("موضوع", "Mawdu' (fabricated)"), ("إسناده ضعيف", "Da'if (weak)"), ("حسن صحيح", "Hasan Sahih"), ("صحيح", "Sahih (authentic)"), ("ليس بصحيح", "Sahih (authentic)"), ("لا يصح", "Other: لا يصح")],
)
def test_verdict_class(spark, text, name):
    assert one(spark, X.verdict_class, text) == name


def test_verdict_negation_is_flagged(spark):
    assert one(spark, X.verdict_negated, "ليس بصحيح") and not one(spark, X.verdict_negated, "صحيح")


@pytest.mark.parametrize(
    ("raw", "name", "key"),
    [
        ("It was narrated that Anas bin Malik said", "anas bin malik", "anas ibn malik"),
        ("Narrated Abu Said Al-Khudri (may Allah be pleased with him)", "abu said al-khudri", "abu said alkhudri"),
        ("Narrated Abu Hurairah", "abu hurairah", "abu hurayra"),
        ("Abdullah bin Umar", "abdullah bin umar", "abd allah ibn umar"),
        ("AbdurRahman bin Auf", "abdurrahman bin auf", "abd alrahman ibn auf"),
        ("Abu", "", ""),
        (None, "", ""),
        ("Narrated On the authority of from Jabir:", "jabir", "jabir"),
    ],
)
def test_names(spark, raw, name, key):
    assert one(spark, N.clean_name, raw) == name
    assert one(spark, lambda c: N.match_key(N.clean_name(c)), raw) == key


@pytest.mark.parametrize(("typed", "year"), [("12.7", 12), ("abc", None), ("-", None), ("1500", None), ("NAN", None), ("inf", None), (None, None), (" 99 ", 99), ("0", 0)])
def test_tolerant_int(spark, typed, year):
    assert one(spark, X.tolerant_int, typed) == year


def test_generation_windows(spark):
    got = one(spark, N.generation, "Follower(Tabi')")
    assert (got.label, got.rank, got.low, got.high) == ("Successor", 2, 60, 190)
    assert one(spark, N.generation, "Succ. (Taba' Tabi')").label == "Successor's successor"
    assert one(spark, N.generation, None).label == "Unplaced"
    assert one(spark, N.generation, "Companion").rank == 1


@pytest.mark.parametrize(("score", "shown"), [(0.125, "0.12"), (0.375, "0.38"), (0.5625, "0.56"), (0.0, "0.00"), (None, None)])
def test_score_text(spark, score, shown):
    assert one(spark, X.score_text, score, "double") == shown


@pytest.mark.parametrize(
    ("start", "end", "text", "error"),
    [("b", "c", "…b c…", None), (None, "b", "a b…", None), ("c", None, "…c d", None), ("z", None, None, "start"), ("a", "z", None, "end"), ("c", "b", None, "end"), (None, None, "a b c d", None), ("", "d", "a b c d", None)],
)
def test_excerpt(spark, start, end, text, error):
    got = spark.createDataFrame([("a  b c d", start, end)], "x string, s string, e string").select(X.excerpt(F.col("x"), F.col("s"), F.col("e")).alias("r")).first().r
    assert (got.text, got.error) == (text, error)


def test_title_case_raises_after_apostrophes_and_hyphens(spark):
    assert one(spark, X.title_case, "umar ibn al-khattab's") == "Umar Ibn Al-Khattab'S"


def test_collapse_knows_every_space(spark):
    assert one(spark, X.collapse, " a  \n b ") == "a b"


def test_profiles_differ_in_hamza(spark):
    assert one(spark, lambda c: X.normalise(c, CORPUS), "سائل") == "سايل"
    assert one(spark, lambda c: X.normalise(c, VERDICT), "سائل") == "ساول"
    assert one(spark, lambda c: X.normalise(c, VERDICT), "ﻻ ﷺ x") != ""


def test_normalise_is_idempotent_and_null_safe(spark):
    for profile in (CORPUS, VERDICT):
        f = lambda c, p=profile: X.normalise(c, p)
        once = one(spark, f, "إِسْنَادُهُ ضَعِيفٌ ىة")
        assert one(spark, f, once) == once
        assert one(spark, f, None) == ""


def test_stop_words_leak_unless_normalised(spark):
    words = lambda p: one(spark, lambda c: X.words(c, p), "صلى قال الصلاه")
    assert "صلي" in words(CORPUS) and "صلي" not in words(CORPUS.with_normal_stop_words())


def test_attribution_needs_marker_and_cue(spark):
    f = lambda c: X.is_attributed(c)
    assert one(spark, f, "حدثنا فلان عن النبي") and not one(spark, f, "ذكر النبي فقط") and not one(spark, f, "حدثنا فلان") and not one(spark, f, None)


def test_query_phrase(spark):
    long = " ".join(f"w{i}" for i in range(12))
    assert one(spark, X.query_phrase, long) == "w4 w5 w6 w7 w8 w9 w10"
    assert one(spark, X.query_phrase, "a b c") == "a b c"
    assert one(spark, X.query_phrase, None) == ""


@pytest.mark.parametrize(("a", "b", "shared", "jac", "cov"), [(10, 10, 8, 8 / 12, 0.8), (20, 9, 7, 7 / 22, 7 / 9), (18, 9, 8, 8 / 19, 8 / 9), (3, 0, 0, 0.0, None), (0, 0, 0, None, None)])
def test_similarity(spark, a, b, shared, jac, cov):
    x = [f"s{i}" for i in range(shared)] + [f"a{i}" for i in range(a - shared)]
    y = [f"s{i}" for i in range(shared)] + [f"b{i}" for i in range(b - shared)]
    df = spark.createDataFrame([(x, y)], "x array<string>, y array<string>")
    got = df.select(X.jaccard(F.col("x"), F.col("y")), X.coverage(F.col("x"), F.col("y")), X.jaccard(F.col("y"), F.col("x"))).first()
    assert got[0] == pytest.approx(jac) if jac is not None else got[0] is None
    assert got[1] == pytest.approx(cov) if cov is not None else got[1] is None
    assert got[0] == got[2]


def test_names_of_files(spark):
    df = spark.createDataFrame([("a/b/c.src.json",), ("plain",), ("a/",), (None,)], "p string")
    got = [tuple(r) for r in df.select(X.basename(F.col("p")), X.swap_suffix(F.col("p"), ".src.json", ".json")).collect()]
    assert got == [("c.src.json", "a/b/c.json"), ("plain", "plain"), ("", "a/"), (None, None)]


def test_attribution_looks_at_narrator_and_text(spark):
    df = spark.createDataFrame([("حدثنا فلان", "قال رسول الله"), (None, "قال رسول الله عن"), ("حدثنا", None), (None, None)], "nr string, x string")
    assert [r[0] for r in df.select(X.is_attributed_by(F.col("nr"), F.col("x"))).collect()] == [True, True, False, False]
