"""Queries of the text and record problems, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sanadflow.llm import languages, leaks, mixing, neardup, people, subjects, textform, words
from sanadflow.sources.tables import table


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = neardup.similar_pairs(table(spark, folder, "openiti"), "entry_id", "ar")
    return pairs.select(F.col("a").alias("entry_id_a"), F.col("b").alias("entry_id_b"))


def p4_groups(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.similar_groups(table(spark, folder, "openiti"), "entry_id", "ar").withColumnRenamed("id", "entry_id")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    parts = [(tab, textform.same_look_pairs(table(spark, folder, tab), id_col, text)) for tab, id_col, text in (("hadith", "row_id", "x"), ("openiti", "entry_id", "ar"))]
    (first, a), (second, b) = parts
    return a.select(F.lit(first).alias("tab"), "id_a", "id_b").unionAll(b.select(F.lit(second).alias("tab"), "id_a", "id_b"))


def p6_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every wording with its look and its stored form."""
    parts = [textform.look_groups(table(spark, folder, tab), id_col, text).select(F.lit(tab).alias("tab"), "id", "look_id", "form_id", "forms") for tab, id_col, text in (("hadith", "row_id", "x"), ("openiti", "entry_id", "ar"))]
    return parts[0].unionByName(parts[1])


def p5_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every typed narrator with the person named."""
    return people.same_person_groups(table(spark, folder, "hadith"), "nr").withColumnRenamed("value", "nr")


def p6_canonical(spark: SparkSession, folder: str) -> DataFrame:
    """Every wording in its two forms."""
    h = table(spark, folder, "hadith").select(F.lit("hadith").alias("tab"), F.col("row_id").alias("id"), F.col("x").alias("text"))
    o = table(spark, folder, "openiti").select(F.lit("openiti").alias("tab"), F.col("entry_id").alias("id"), F.col("ar").alias("text"))
    return textform.with_forms(h.unionAll(o), "text").drop("text")


#: Problem 7: two fifths of an item, in its order, in at most two stretches; shorter quotations are no case.
QUOTED = leaks.Leaks(stretches=2, run=None, least=8)


def p7_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with any leaked stretches, the share of each item and the spans of characters to remove."""
    docs = table(spark, folder, "documents")
    return leaks.in_characters(docs, "doc_id", "text", leaks.leaks(docs, "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "text"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaks(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "text", QUOTED).select("doc_id", "item_id")


def p2_subjects(spark: SparkSession, folder: str) -> DataFrame:
    """Every wording with its subject areas and their posteriors."""
    return subjects.subjects(table(spark, folder, "hadith"), "row_id", "x", "t", table(spark, folder, "topic_lexicon"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """At least two sentences treat the topic, so a text of one sentence is no case."""
    return subjects.subjects(table(spark, folder, "hadith"), "row_id", "x", "t", table(spark, folder, "topic_lexicon"), subjects.Subjects(fewer=False)).select("row_id", "topic")


def p2_makeup(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each collection by subject area; a row counts for each of its subjects, '' stands for none."""
    rows = table(spark, folder, "hadith").select("row_id", "s")
    every = rows.join(p2_found(spark, folder), "row_id", "left").withColumn("topic", F.coalesce("topic", F.lit("")))
    held = rows.groupBy("s").agg(F.count("*").alias("in_collection"))
    made = every.groupBy("s", "topic").agg(F.count("*").alias("n_rows"))
    return made.join(held, "s").select("s", "topic", "n_rows", (F.col("n_rows") / F.col("in_collection")).alias("share"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return languages.mislabelled(table(spark, folder, "documents"), "doc_id", "text", "lang")


def p9_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Every stretch of every document with its language and confidence."""
    found = languages.languages(table(spark, folder, "documents"), "doc_id", "text", "lang")
    return found.select("doc_id", F.explode("segments").alias("s")).select("doc_id", "s.*")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return people.same_person_pairs(table(spark, folder, "hadith"), "nr").select(F.col("a").alias("nr_a"), F.col("b").alias("nr_b"))


def p3_links(spark: SparkSession, folder: str) -> DataFrame:
    """Typed narrators with the biographies of that person and a confidence."""
    bios = table(spark, folder, "kaggle_rawis")
    return people.linked(table(spark, folder, "hadith"), "nr", bios, "scholar_indx", "name", "death_date_hijri").withColumnRenamed("value", "nr")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_links(spark, folder).select("nr", "scholar_indx")


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The mixture: documents with their number of copies."""
    return mixing.mix(table(spark, folder, "documents"), "doc_id", "text", "source", table(spark, folder, "mix_targets"))[0]


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and actual share of every source."""
    return mixing.mix(table(spark, folder, "documents"), "doc_id", "text", "source", table(spark, folder, "mix_targets"))[1]


QUERIES = {"p8_mix": p8_mix, "p8_shares": p8_shares, "p3_found": p3_found, "p3_links": p3_links, "p5_found": p5_found, "p5_groups": p5_groups, "p9_found": p9_found, "p9_segments": p9_segments, "p2_found": p2_found, "p2_subjects": p2_subjects, "p2_makeup": p2_makeup, "p7_found": p7_found, "p7_spans": p7_spans, "p4_found": p4_found, "p4_groups": p4_groups, "p6_found": p6_found, "p6_groups": p6_groups, "p6_canonical": p6_canonical}


def _texts(*tables: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{tab}' AS tab, {id_col} AS id, {text} AS x FROM {tab} WHERE {text} IS NOT NULL" for tab, id_col, text in tables)


def _looks(texts: str) -> str:
    """SQL of ``textform.look``: every character through the table of what it looks like, composed before and after."""
    marks = [(chr(o), textform._LOOK[o]) for o in range(0x80, 0xFFFF) if not 0xD800 <= o < 0xE000 and textform._LOOK[o] != chr(o)]
    rows = ", ".join(f"({ord(a)}, '{b.replace(chr(39), chr(39) * 2)}')" for a, b in marks)
    shape = "".join(map(chr, textform._SHAPE)), "".join(textform._SHAPE.values())
    return f"""given AS MATERIALIZED ({texts}), mark(o, t) AS (VALUES {rows}), letter AS (SELECT tab, id, unnest(string_split(nfc_normalize(x), '')) AS c, generate_subscripts(string_split(nfc_normalize(x), ''), 1) AS i FROM given WHERE x <> ''),
look AS MATERIALIZED (SELECT g.tab, g.id, g.x, translate(nfc_normalize(coalesce(l.l, '')), '{shape[0]}', '{shape[1]}') AS l FROM given g LEFT JOIN (SELECT tab, id, string_agg(coalesce(t, c), '' ORDER BY i) AS l FROM letter LEFT JOIN mark ON o = unicode(c) GROUP BY 1, 2) l ON l.tab = g.tab AND l.id = g.id)"""


_FOLDED = words.ARABIC_FOLDS[:-1]
SQL: dict[str, str] = {
    "p6_found": f"WITH {_looks(_texts(('hadith', 'row_id', 'x'), ('openiti', 'entry_id', 'ar')))} SELECT a.tab, a.id AS id_a, b.id AS id_b FROM look a JOIN look b ON a.tab = b.tab AND a.l = b.l AND a.id < b.id AND a.x <> b.x",
    # All pairs that share a word, by their shared words.
    "p4_found": f"""WITH {_looks(_texts(("openiti", "entry_id", "ar")))},
bag AS MATERIALIZED (SELECT id, list_distinct(regexp_extract_all(translate(regexp_replace(lower(l), '[\\p{{M}}\\p{{Cf}}{words.ARABIC_FOLDS[-1][0]}]', '', 'g'), '{''.join(a for a, _ in _FOLDED)}', '{''.join(b * len(a) for a, b in _FOLDED)}'), '[\\p{{L}}\\p{{N}}]+')) AS w FROM look),
word AS MATERIALIZED (SELECT id, len(w) AS n, unnest(w) AS w FROM bag), common AS (SELECT a.id AS a, b.id AS b, a.n AS na, b.n AS nb, count(*) AS i FROM word a JOIN word b ON a.w = b.w AND a.id < b.id GROUP BY 1, 2, 3, 4)
SELECT a AS entry_id_a, b AS entry_id_b FROM common WHERE i >= 0.6 * (na + nb - i)""",
}
