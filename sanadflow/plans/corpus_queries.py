"""Queries over the collections, editions and biographies, with their SQL."""

from __future__ import annotations

import unicodedata
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sanadflow.functions import names as N
from sanadflow.functions import text as X
from sanadflow.functions.profiles import CORPUS, LATIN, VERDICT
from sanadflow.operators import dedupe, facets, match, people, references, topics
from sanadflow.plans.extract import extract
from sanadflow.plans.layout import checkpoint_dir, cleaning, spread, stored
from sanadflow.sources import editions
from sanadflow.sources.tables import table
from sanadflow.streaming.grader import first_deliveries

#: The editions here carry a report marker instead of the usual attribution.
EDITION = replace(CORPUS, markers=("بلغنا", "سمعت"))
LEAST_CHARS = 40
FLAGSHIPS = ("dirwan", "maqsal")

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# SQL of what the queries share; DuckDB's regular expressions know neither (?U) nor \b beyond ASCII.
_SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _flat(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_SPACE}', ' ', 'g'))"


def _norm(c: str) -> str:
    return f"translate(regexp_replace(coalesce({c}, ''), '[{CORPUS.marks}]', '', 'g'), '{CORPUS.pairs[0]}', '{CORPUS.pairs[1]}')"


def _arabic(c: str) -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(CORPUS.stop))
    return f"list_sort(list_distinct(list_filter(regexp_extract_all({_norm(c)}, '[ء-ي]+'), lambda w: length(w) > 2 AND w NOT IN ({stop}))))"


def _latin(c: str) -> str:
    return f"list_sort(list_distinct(list_filter(regexp_extract_all(lower(coalesce({c}, '')), '\\p{{L}}+'), lambda w: length(w) > 2)))"


_ATTRIBUTED = f"regexp_matches({_norm('ar')}, '{'|'.join(EDITION.markers)}') AND regexp_matches({_norm('ar')}, '{'|'.join(EDITION.cues)}') AND length(ar) > {LEAST_CHARS}"
_SETS = f"sets AS MATERIALIZED (SELECT collection AS scope, entry_id AS ord, {_arabic('ar')} AS tokens FROM openiti WHERE {_ATTRIBUTED})"
_DF = "word AS MATERIALIZED (SELECT scope, ord, unnest(tokens) AS token FROM sets), df AS (SELECT scope, token, count(*) AS df FROM word GROUP BY 1, 2)"
_RARE = """rare AS MATERIALIZED (SELECT scope, ord, token, df FROM (SELECT w.scope, w.ord, w.token, d.df, row_number() OVER (PARTITION BY w.scope, w.ord ORDER BY d.df, w.token) AS r
  FROM word w JOIN df d ON w.scope = d.scope AND w.token = d.token JOIN sets s ON s.scope = w.scope AND s.ord = w.ord WHERE len(s.tokens) >= 5 AND d.df <= 500) WHERE r <= 6)"""
_PAIRS = "pairs AS MATERIALIZED (SELECT DISTINCT x.scope, x.ord AS a, y.ord AS b FROM rare x JOIN rare y ON x.scope = y.scope AND x.token = y.token AND x.ord < y.ord)"
_EDGES = """edges AS MATERIALIZED (SELECT scope, a, b, jaccard FROM (SELECT p.scope, a, b, i / (la + lb - i) AS jaccard, i / least(la, lb) AS cov FROM (
  SELECT p.scope, p.a, p.b, len(list_intersect(x.tokens, y.tokens))::DOUBLE AS i, len(x.tokens) AS la, len(y.tokens) AS lb FROM pairs p
  JOIN sets x ON x.scope = p.scope AND x.ord = p.a JOIN sets y ON y.scope = p.scope AND y.ord = p.b) p) WHERE jaccard >= 0.48 OR (cov >= 0.72 AND jaccard >= 0.35))"""
# Of collection_funnel and the extraction: every similar pair, whatever words it shares.
_ALL_EDGES = """word AS MATERIALIZED (SELECT scope, ord, len(tokens) AS l, unnest(tokens) AS token FROM sets WHERE len(tokens) >= 5),
edges AS MATERIALIZED (SELECT scope, a, b, jaccard FROM (SELECT scope, a, b, i / (la + lb - i) AS jaccard, i / least(la, lb) AS cov FROM (
  SELECT x.scope, x.ord AS a, y.ord AS b, count(*)::DOUBLE AS i, x.l AS la, y.l AS lb FROM word x JOIN word y ON x.scope = y.scope AND x.token = y.token AND x.ord < y.ord GROUP BY x.scope, x.ord, y.ord, x.l, y.l)) WHERE jaccard >= 0.48 OR (cov >= 0.72 AND jaccard >= 0.35))"""
# Greedy in order: a node is kept unless an earlier kept node is its neighbour.
_WALK = """node AS MATERIALIZED (SELECT ord, row_number() OVER (ORDER BY ord) AS i FROM (SELECT a AS ord FROM edges UNION SELECT b FROM edges)),
before AS MATERIALIZED (SELECT n.i, n.ord, list(e.a) FILTER (e.a IS NOT NULL) AS earlier FROM node n LEFT JOIN edges e ON e.b = n.ord GROUP BY 1, 2),
walk(i, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT b.i, CASE WHEN list_has_any(coalesce(b.earlier, []), w.kept) THEN w.kept ELSE list_append(w.kept, b.ord) END FROM walk w JOIN before b ON b.i = w.i + 1),
chosen AS MATERIALIZED (SELECT unnest(kept) AS ord FROM (SELECT kept FROM walk ORDER BY i DESC LIMIT 1)),
merged AS MATERIALIZED (SELECT n.ord, min(e.a) AS kept FROM node n JOIN edges e ON e.b = n.ord JOIN chosen c ON c.ord = e.a WHERE n.ord NOT IN (SELECT ord FROM chosen) GROUP BY 1),
state AS MATERIALIZED (SELECT s.scope, s.ord, CASE WHEN len(s.tokens) < 5 THEN 'short' WHEN m.kept IS NOT NULL THEN 'merged' ELSE 'kept' END AS status, CASE WHEN len(s.tokens) < 5 THEN NULL ELSE coalesce(m.kept, s.ord) END AS kept
  FROM sets s LEFT JOIN merged m ON m.ord = s.ord)"""


def _attributed(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "openiti").select("entry_id", "collection", "n", "ar")
    return spread(rows).where(X.is_attributed(F.col("ar"), EDITION) & (F.length("ar") > LEAST_CHARS))


def _sets(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe.token_sets(_attributed(spark, folder), "collection", "entry_id", "ar", EDITION)


# ---- normalisation, attribution, merge of near-duplicates


@query(f"SELECT entry_id, {_norm('ar')} AS plain FROM openiti")
def normalised_editions(spark, folder):
    return table(spark, folder, "openiti").select("entry_id", X.normalise(F.col("ar"), CORPUS).alias("plain"))


# What compatibility composition makes Arabic letters or marks of; all else is blanked by the profile anyway.
_ARABIC_FORMS = ", ".join(f"({o}, '{x}')" for o in range(0x80, 0xFFFF) if not 0xD800 <= o < 0xE000 and (x := unicodedata.normalize("NFKC", chr(o))) != chr(o) and any("؀" <= c <= "ۿ" for c in x))
_VERDICT_TEXT = f"""form(o, t) AS (VALUES {_ARABIC_FORMS}), letter AS (SELECT entry_id, unnest(string_split(ar, '')) AS c, generate_subscripts(string_split(ar, ''), 1) AS i FROM openiti),
composed AS (SELECT entry_id, nfc_normalize(string_agg(coalesce(t, c), '' ORDER BY i)) AS x FROM letter LEFT JOIN form ON o = unicode(c) GROUP BY 1),
plain AS MATERIALIZED (SELECT o.entry_id, o.ar, {_flat(f"regexp_replace(translate(regexp_replace(coalesce(x, ''), '[{VERDICT.marks}]', '', 'g'), '{VERDICT.pairs[0]}', '{VERDICT.pairs[1]}'), '[^{VERDICT.words} ]', ' ', 'g')")} AS plain FROM openiti o LEFT JOIN composed c ON c.entry_id = o.entry_id)"""
_VERDICT_CASES = " ".join(f"WHEN regexp_matches(plain, '{'|'.join(found)}') THEN '{name.replace(chr(39), chr(39) * 2)}'" for found, name in X.VERDICTS)


@query(f"WITH {_VERDICT_TEXT} SELECT entry_id, plain FROM plain")
def normalised_verdict_profile(spark, folder):
    return table(spark, folder, "openiti").select("entry_id", X.normalise(F.col("ar"), VERDICT).alias("plain"))


@query(f"SELECT entry_id, collection FROM openiti WHERE {_ATTRIBUTED}")
def attribution_filter(spark, folder):
    return _attributed(spark, folder).select("entry_id", "collection")


@query(f"SELECT row_id FROM hadith WHERE regexp_matches(lower(concat_ws(' ', nr, x)), 'envoy|elder') AND regexp_matches(lower(concat_ws(' ', nr, x)), 'narrated|reported|authority')")
def attribution_by_narrator(spark, folder):
    """Rows attributed by what stands in the narrator's field or in the wording."""
    profile = replace(LATIN, markers=("envoy", "elder"), cues=("narrated", "reported", "authority"))
    return table(spark, folder, "hadith").where(X.is_attributed_by(F.col("nr"), F.col("x"), profile)).select("row_id")


@query(f"WITH {_SETS} SELECT scope, ord, array_to_string(tokens, ' ') AS tokens FROM sets")
def tokens_distinct(spark, folder):
    return _sets(spark, folder).select("scope", "ord", F.array_join("tokens", " ").alias("tokens"))


@query(f"WITH {_SETS}, {_DF} SELECT * FROM df")
def token_df(spark, folder):
    return dedupe.token_df(_sets(spark, folder))


@query(f"WITH {_SETS}, {_DF}, {_RARE} SELECT * FROM rare")
def rare_tokens_top6(spark, folder):
    return dedupe.rare_tokens(stored(_sets(spark, folder)))


@query(f"WITH {_SETS}, {_DF}, {_RARE}, {_PAIRS} SELECT * FROM pairs")
def dup_candidate_pairs(spark, folder):
    return dedupe.candidate_pairs(stored(_sets(spark, folder)))


@query(f"WITH {_SETS}, {_DF}, {_RARE}, {_PAIRS}, {_EDGES} SELECT scope, a, b, round(jaccard, 9) AS jaccard FROM edges")
def dup_edges(spark, folder):
    return dedupe.duplicate_edges(stored(_sets(spark, folder))).withColumn("jaccard", F.round("jaccard", 9))


@query(f"WITH RECURSIVE {_SETS}, {_DF}, {_RARE}, {_PAIRS}, {_EDGES}, {_WALK} SELECT scope, ord, status, kept::VARCHAR AS kept FROM state")
def dedupe_states(spark, folder):
    return dedupe.merge_duplicates(_sets(spark, folder)).withColumn("kept", F.col("kept").cast("string"))


@query(
    f"WITH RECURSIVE {_SETS}, {_DF}, {_RARE}, {_PAIRS}, {_EDGES}, {_WALK} SELECT k.scope, k.ord, count(m.ord) AS dups, coalesce(string_agg(m.ord::VARCHAR, ' ' ORDER BY m.ord), '') AS members "
    "FROM state k LEFT JOIN state m ON m.status = 'merged' AND m.kept = k.ord WHERE k.status = 'kept' GROUP BY 1, 2"
)
def dedupe_kept(spark, folder):
    return dedupe.kept_records(dedupe.merge_duplicates(_sets(spark, folder))).withColumn("members", F.array_join(F.transform("members", lambda x: x.cast("string")), " "))


@query(
    f"WITH RECURSIVE {_SETS}, {_ALL_EDGES}, {_WALK} SELECT o.collection, o.parsed, coalesce(s.attributed, 0) AS attributed, coalesce(s.uniq, 0) AS uniq, coalesce(s.short, 0) AS short "
    "FROM (SELECT collection, count(*) AS parsed FROM openiti GROUP BY 1) o LEFT JOIN (SELECT scope, count(*) AS attributed, count(*) FILTER (status = 'kept') AS uniq, count(*) FILTER (status = 'short') AS short FROM state GROUP BY 1) s ON s.scope = o.collection"
)
def collection_funnel(spark, folder):
    """Records of each collection as parsed, as attributed and as unique."""
    parsed = table(spark, folder, "openiti").groupBy("collection").agg(F.count("*").alias("parsed"))
    states = dedupe.merge_duplicates(_sets(spark, folder), dedupe.EVERY).groupBy(F.col("scope").alias("collection")).agg(F.count("*").alias("attributed"), F.count_if(F.col("status") == "kept").alias("uniq"), F.count_if(F.col("status") == "short").alias("short"))
    return parsed.join(states, "collection", "left").na.fill(0, ["attributed", "uniq", "short"])


@query("SELECT split_part(source_file, '.', 1) AS author, split_part(source_file, '.', 2) AS work, sum(strlen(ar))::BIGINT AS size FROM openiti WHERE source_file IS NOT NULL GROUP BY 1, 2")
def catalog_size(spark, folder):
    """Authors and works of the editions with the bytes of their entries, through an archive listing."""
    parts = F.split("source_file", r"\.")
    listing = table(spark, folder, "openiti").select(F.concat_ws("/", F.lit("archive"), F.lit("data"), parts[0], parts[1], "source_file").alias("path"), F.octet_length("ar").cast("long").alias("size"))
    return editions.catalogue(listing)


# ---- topics


_TOPIC_SETS = f"sets AS MATERIALIZED (SELECT row_id AS ord, {_latin('x')} AS tokens FROM hadith)"
_SCORES = """word AS MATERIALIZED (SELECT ord, unnest(tokens) AS token FROM sets), lex AS (SELECT DISTINCT topic, topic_ord, keyword FROM topic_lexicon WHERE keyword IS NOT NULL),
points AS (SELECT ord, topic, topic_ord, 2 AS p FROM word JOIN lex ON token = keyword
  UNION ALL SELECT ord, topic, topic_ord, 1 FROM (SELECT DISTINCT ord, topic, topic_ord, keyword FROM word JOIN lex ON left(token, 5) = left(keyword, 5) AND length(token) >= 5 AND length(keyword) >= 5 AND token <> keyword)),
scores AS MATERIALIZED (SELECT ord, topic, topic_ord, sum(p)::BIGINT AS score FROM points GROUP BY 1, 2, 3)"""
_CHOSEN = """best AS (SELECT ord, topic, score, row_number() OVER (PARTITION BY ord ORDER BY score DESC, topic_ord) AS r, max(score) OVER (PARTITION BY ord) AS top FROM scores),
chosen AS MATERIALIZED (SELECT ord, string_agg(topic, '; ' ORDER BY r) AS topics FROM best WHERE CASE WHEN top >= 4 THEN score >= 4 AND r <= 4 WHEN top >= 2 THEN score >= 2 AND r <= 2 ELSE r = 1 END GROUP BY 1),
tagged AS MATERIALIZED (SELECT s.ord, coalesce(c.topics, 'Other Narrations') AS topics FROM sets s LEFT JOIN chosen c ON c.ord = s.ord)"""


def _topic_sets(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "hadith").select("row_id", "x")).select(F.col("row_id").alias("ord"), X.word_set(F.col("x"), LATIN).alias("tokens"))


@query(f"WITH {_TOPIC_SETS}, {_SCORES} SELECT * FROM scores")
def topic_scores(spark, folder):
    return topics.topic_scores(_topic_sets(spark, folder), table(spark, folder, "topic_lexicon"))


@query(f"WITH {_TOPIC_SETS}, {_SCORES}, {_CHOSEN} SELECT * FROM tagged")
def topic_assign(spark, folder):
    return topics.assign_topics(_topic_sets(spark, folder), table(spark, folder, "topic_lexicon")).withColumn("topics", F.array_join("topics", "; "))


@query("SELECT topic, keyword, CASE WHEN length(keyword) < 3 THEN 'too short' ELSE 'not in normal form' END AS reason FROM topic_lexicon WHERE length(keyword) < 3 OR regexp_replace(lower(keyword), '[^\\p{L}]+', '', 'g') <> keyword")
def topic_keyword_lint(spark, folder):
    return topics.lint_lexicon(table(spark, folder, "topic_lexicon"), lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}]+", ""))


@query("SELECT topic, count(*) AS n, round(count(*) / (SELECT count(*) FROM hadith)::DOUBLE, 9) AS share, count(*) / (SELECT count(*) FROM hadith)::DOUBLE > 0.15 AS over FROM (SELECT unnest(list_distinct(t)) AS topic FROM hadith) GROUP BY 1")
def topic_share_check(spark, folder):
    return facets.topic_shares(table(spark, folder, "hadith")).withColumn("share", F.round("share", 9))


# ---- similarity joins and verdicts


@query(
    f"""WITH q AS MATERIALIZED (SELECT item_id AS id, {_latin("text")} AS t FROM eval_items), c AS MATERIALIZED (SELECT doc_id AS cand, {_latin("text")} AS t FROM documents),
common AS (SELECT m.id, w.cand, count(*)::DOUBLE AS i FROM (SELECT id, unnest(t) AS w FROM q WHERE len(t) >= 4) m JOIN (SELECT cand, unnest(t) AS w FROM c) w ON m.w = w.w GROUP BY 1, 2),
scored AS (SELECT p.id, p.cand, greatest(i / (len(q.t) + len(c.t) - i), i / least(len(q.t), len(c.t)) * 0.9) AS s FROM common p JOIN q ON q.id = p.id JOIN c ON c.cand = p.cand),
best AS (SELECT id, cand, s FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, cand) AS r FROM scored) WHERE r = 1)
SELECT q.id, CASE WHEN len(q.t) < 4 THEN 'too short to match' WHEN s >= 0.45 THEN 'matched' ELSE 'no confident match' END AS label, CASE WHEN s >= 0.45 THEN cand::VARCHAR END AS match, CASE WHEN len(q.t) >= 4 THEN round(coalesce(s, 0), 9) END AS score FROM q LEFT JOIN best ON best.id = q.id"""
)
def verdict_match(spark, folder):
    """The most similar document of every test passage."""
    rows = table(spark, folder, "eval_items").select(F.col("item_id").alias("id"), X.word_set(F.col("text"), LATIN).alias("tokens"))
    corpus = spread(table(spark, folder, "documents").select("doc_id", "text")).select(F.col("doc_id").alias("cand"), F.col("doc_id").alias("ord"), X.word_set(F.col("text"), LATIN).alias("tokens"))
    return match.best_in_corpus(rows, corpus).withColumn("score", F.round("score", 9)).withColumn("match", F.col("match").cast("string"))


_PHRASE = f"(CASE WHEN len(w) - floor(len(w) / 3) >= 7 THEN array_to_string(list_slice(w, (floor(len(w) / 3) + 1)::INT, (floor(len(w) / 3) + 7)::INT), ' ') ELSE array_to_string(list_slice(w, 1, 7), ' ') END)"


@query(f"SELECT row_id, {_PHRASE} AS phrase FROM (SELECT row_id, string_split({_flat(chr(99) + 'oalesce(x, ' + chr(39) * 2 + ')')}, ' ') AS w FROM hadith)")
def query_phrases(spark, folder):
    return table(spark, folder, "hadith").select("row_id", X.query_phrase(F.col("x")).alias("phrase"))


@query(f"WITH {_VERDICT_TEXT} SELECT entry_id, CASE WHEN plain = '' THEN 'Ungraded' {_VERDICT_CASES} ELSE 'Other: ' || substring(ar, 1, 40) END AS verdict, regexp_matches(plain, '(^| )(ليس|لا|غير|لم)( |$)') AS negated FROM plain")
def verdict_classes(spark, folder):
    """Verdict classes of wordings, with the flag that a negation was passed over."""
    return table(spark, folder, "openiti").select("entry_id", X.verdict_class(F.col("ar")).alias("verdict"), X.verdict_negated(F.col("ar")).alias("negated"))


@query(
    f"""WITH r AS MATERIALIZED (SELECT row_id AS id, {_PHRASE} AS phrase, {_latin("x")} AS t FROM (SELECT row_id, x, string_split({_flat("x")}, ' ') AS w FROM hadith WHERE x IS NOT NULL)),
p AS MATERIALIZED (SELECT DISTINCT phrase FROM r WHERE phrase <> '' AND len(t) >= 4), c AS MATERIALIZED (SELECT doc_id AS cand, ' ' || {_flat("text")} || ' ' AS whole, {_latin("text")} AS t FROM documents WHERE text IS NOT NULL),
held AS MATERIALIZED (SELECT phrase, cand, t FROM p JOIN c ON contains(whole, ' ' || phrase || ' ')),
scored AS (SELECT id, cand, greatest(i / (a + b - i), i / least(a, b) * 0.9) AS s FROM (SELECT r.id, h.cand, len(list_intersect(r.t, h.t))::DOUBLE AS i, len(r.t) AS a, len(h.t) AS b FROM r JOIN held h ON h.phrase = r.phrase WHERE len(r.t) >= 4)),
best AS (SELECT id, cand, s FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, cand) AS k FROM scored) WHERE k = 1)
SELECT r.id, CASE WHEN len(r.t) < 4 THEN 'too short to match' WHEN s >= 0.45 THEN 'matched' ELSE 'no confident match' END AS label, CASE WHEN s >= 0.45 THEN cand::VARCHAR END AS match, CASE WHEN len(r.t) >= 4 THEN printf('%.2f', coalesce(s, 0)) END AS score FROM r LEFT JOIN best ON best.id = r.id"""
)
def graded_rows(spark, folder):
    """Rows matched with the documents that hold their phrase, at whatever place, scored to two decimals."""
    rows = table(spark, folder, "hadith").where("x is not null").select(F.col("row_id").alias("id"), X.query_phrase(F.col("x")).alias("phrase"), X.word_set(F.col("x"), LATIN).alias("tokens"))
    texts = spread(table(spark, folder, "documents").where("text is not null").select("doc_id", "text"))
    texts = texts.select(F.col("doc_id").alias("cand"), F.col("doc_id").alias("ord"), X.spaced_words(F.col("text")).alias("words"), X.word_set(F.col("text"), LATIN).alias("tokens"))
    return match.graded_by_phrase(rows, texts).withColumn("match", F.col("match").cast("string"))


# ---- facets, search, gates


@query("SELECT g AS grade, count(*) AS n FROM hadith GROUP BY 1")
def grade_histogram(spark, folder):
    return table(spark, folder, "hadith").groupBy(F.col("g").alias("grade")).agg(F.count("*").alias("n"))


@query("SELECT s, coalesce(g, 'No grading source') AS grade, count(*) AS n FROM hadith GROUP BY 1, 2")
def grade_by_collection(spark, folder):
    return table(spark, folder, "hadith").groupBy("s", F.coalesce("g", F.lit("No grading source")).alias("grade")).agg(F.count("*").alias("n"))


@query("SELECT s, round(avg((g IS NOT NULL)::INT), 9) AS graded, round(avg((b IS NOT NULL)::INT), 9) AS booked FROM hadith GROUP BY 1")
def coverage_by_collection(spark, folder):
    share = lambda c: F.round(F.avg(F.col(c).isNotNull().cast("double")), 9)
    return table(spark, folder, "hadith").groupBy("s").agg(share("g").alias("graded"), share("b").alias("booked"))


@query("SELECT 'collection' AS facet, s AS value, count(*) AS n FROM hadith GROUP BY 2 UNION ALL SELECT 'grade', g, count(*) FROM hadith GROUP BY 2 UNION ALL SELECT 'topic', v, count(*) FROM (SELECT unnest(list_distinct(t)) AS v FROM hadith) GROUP BY 2")
def facet_counts(spark, folder):
    return facets.facet_counts(table(spark, folder, "hadith"))


@query("SELECT row_id, s, n FROM hadith WHERE list_contains(t, 'Fasting') AND s IN ('dirwan', 'maqsal', 'kefrin') AND regexp_matches(g, '^(Sahih|Hasan)')")
def facet_filter(spark, folder):
    rows = facets.facet_filter(table(spark, folder, "hadith"), topic="Fasting", collections=["dirwan", "maqsal", "kefrin"], grade="hasan")
    return rows.select("row_id", "s", "n")


@query("SELECT row_id, g FROM hadith WHERE regexp_matches(g, 'Da''if|^Mawdu')")
def weak_only(spark, folder):
    return facets.facet_filter(table(spark, folder, "hadith"), grade="weak").select("row_id", "g")


@query("SELECT row_id FROM hadith WHERE contains(lower(concat_ws(chr(10), x, nr, b, array_to_string(t, chr(10)))), 'caravan')")
def fulltext_search(spark, folder):
    return facets.facet_filter(table(spark, folder, "hadith"), query="Caravan").select("row_id")


@query("SELECT row_id, s, n, x FROM hadith ORDER BY row_id LIMIT 25 OFFSET 50")
def page_25(spark, folder):
    return facets.page(table(spark, folder, "hadith").select("row_id", "s", "n", "x"), 2, order="row_id")


@query("SELECT row_id, s, n, b, coalesce(g, 'No grading source') AS g, array_to_string(list_slice(also, 1, 3), '; ') AS also, coalesce(q, '') AS q FROM hadith")
def records_published(spark, folder):
    """Records as they are published: defaults filled in, at most three further places."""
    also = F.when(F.col("also").isNotNull(), F.array_join(F.slice("also", 1, 3), "; "))
    return table(spark, folder, "hadith").select("row_id", "s", "n", "b", F.coalesce("g", F.lit("No grading source")).alias("g"), also.alias("also"), F.coalesce("q", F.lit("")).alias("q"))


@query(f"SELECT s, count(*) AS n, count(*) FILTER (g LIKE '%Da''if%' OR g LIKE 'Mawdu%') AS weak FROM hadith WHERE s IN {FLAGSHIPS} GROUP BY 1")
def gate_flagship(spark, folder):
    """What the gate on the flagship collections counts."""
    rows = table(spark, folder, "hadith").where(F.col("s").isin(*FLAGSHIPS))
    return rows.groupBy("s").agg(F.count("*").alias("n"), F.count_if(facets.is_weak(F.col("g"))).alias("weak"))


@query("SELECT 'collection' AS kind, slug AS name FROM graded_collections WHERE slug NOT IN (SELECT s FROM hadith WHERE s IS NOT NULL) UNION ALL SELECT 'edition', title FROM edition_works WHERE title NOT IN (SELECT collection FROM openiti WHERE collection IS NOT NULL)")
def status_antijoin(spark, folder):
    """Collections and editions on the list of which no row is there."""
    a = table(spark, folder, "graded_collections").join(table(spark, folder, "hadith").select(F.col("s").alias("slug")).distinct(), "slug", "left_anti").select(F.lit("collection").alias("kind"), F.col("slug").alias("name"))
    b = table(spark, folder, "edition_works").join(table(spark, folder, "openiti").select(F.col("collection").alias("title")).distinct(), "title", "left_anti").select(F.lit("edition").alias("kind"), F.col("title").alias("name"))
    return a.unionAll(b)


@query(
    """WITH a AS (SELECT 'topics per row' AS name, round(avg(len(t)), 9) AS value, 1.75 AS expected, 0.5 AS tolerance FROM hadith UNION ALL SELECT 'graded share', round(avg((g IS NOT NULL)::INT), 9), 0.9, 0.1 FROM hadith)
SELECT name, value, expected::DOUBLE AS expected, tolerance::DOUBLE AS tolerance, abs(value - expected) <= tolerance * expected AS ok FROM a"""
)
def expectation_report(spark, folder):
    rows = table(spark, folder, "hadith")
    figures = rows.agg(F.round(F.avg(F.when(F.col("t").isNotNull(), F.size("t"))), 9).alias("a"), F.round(F.avg(F.col("g").isNotNull().cast("double")), 9).alias("b")).select(F.explode(F.create_map(F.lit("topics per row"), "a", F.lit("graded share"), "b")).alias("name", "value"))
    return facets.expectations(figures, spark.createDataFrame([("topics per row", 1.75, 0.5), ("graded share", 0.9, 0.1)], "name string, expected double, tolerance double"))


# ---- references


_LAST = "last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s, n ORDER BY row_id DESC) AS r FROM hadith) WHERE r = 1)"


@query(
    f"""WITH {_LAST}, refs AS (SELECT row_id, split_part(u, ':', 1) AS slug, try_cast(split_part(u, ':', 2) AS INT) AS n FROM (SELECT row_id, unnest(also) AS u FROM hadith))
SELECT refs.row_id, refs.slug, refs.n::VARCHAR AS n, c.title AS src, l.g AS grade, CASE WHEN l.s IS NULL THEN refs.slug || ' no.' || refs.n || ' is not in the dataset' END AS error
FROM refs LEFT JOIN last l ON l.s = refs.slug AND l.n = refs.n LEFT JOIN graded_collections c ON c.slug = refs.slug AND l.s IS NOT NULL"""
)
def reference_resolve(spark, folder):
    """The further places of every row, looked up in the dataset."""
    rows = table(spark, folder, "hadith")
    one = rows.select("row_id", F.explode("also").alias("u"))
    parts = F.split("u", ":")
    refs = one.select("row_id", parts[0].alias("slug"), F.get(parts, 1).try_cast("int").alias("n"))
    out = references.resolve(refs, rows.withColumn("ord", F.col("row_id")), table(spark, folder, "graded_collections"), must_start=None)
    return out.select("row_id", "slug", F.col("n").cast("string").alias("n"), "src", "grade", "error")


@query(
    f"""WITH {_LAST}, r AS (SELECT h.row_id, h.s, h.n, h.q, l.g, {_flat("l.x")} AS x FROM hadith h JOIN last l ON l.s = h.s AND l.n = h.n WHERE h.q <> '')
SELECT row_id, CASE WHEN g LIKE 'Sahih%' AND instr(x, q) > 0 THEN CASE WHEN instr(x, q) > 1 THEN '…' ELSE '' END || q || CASE WHEN instr(x, q) + length(q) <= length(x) THEN '…' ELSE '' END END AS text,
CASE WHEN g IS NULL OR NOT g LIKE 'Sahih%' THEN s || ' no.' || n || ' is graded "' || coalesce(g, '') || '", not Sahih' WHEN instr(x, q) = 0 THEN s || ' no.' || n || ' has no passage starting "' || q || '"' END AS error FROM r WHERE x IS NOT NULL"""
)
def excerpts(spark, folder):
    """Every row's phrase quoted from its record, where that is sound and holds it."""
    rows = table(spark, folder, "hadith")
    refs = rows.where("q <> ''").select("row_id", F.col("s").alias("slug"), "n", F.col("q").alias("start"), F.col("q").alias("end"))
    held = rows.withColumn("ord", F.col("row_id"))
    empty = references.resolve(refs, held).join(_without_text(rows), ["slug", "n"], "left_anti")
    return empty.select("row_id", "text", "error")


def _without_text(rows: DataFrame) -> DataFrame:
    last = rows.groupBy("s", "n").agg(F.max_by(F.struct("x"), "row_id").alias("v"))
    return last.where("v.x is null").select(F.col("s").alias("slug"), "n")


# ---- people


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _replaced(c: str, pattern: str, to: str) -> str:
    return f"regexp_replace({c}, {_sql_text(pattern)}, {_sql_text(to)}, 'g')"


def _sql_clean(c: str) -> str:
    """SQL of ``names.clean_name``; what its patterns look ahead for is matched and put back."""
    out = _replaced(f"trim(coalesce({c}, ''))", rf"(?i)\([^)]*(?:{N.ASIDE})[^)]*\)", "")
    out = f"lower({out})"
    for pattern in N.HONORIFICS:
        out = _replaced(out, "(?i)" + pattern, " ")
    out = _replaced(f"trim({out})", f"(?i)^(?:(?:{'|'.join(N.OPENINGS)})\\s*)+", "")
    out = _replaced(f"trim({out})", "(?i)" + N.PARTICLES.replace("(?=", "("), "\\1\x01\\2")
    for pattern in N.ENDINGS:
        out = _replaced(out, "(?i)" + pattern, "")
    edges = "".join("\\" + e if e in "-()'\"[]^" else e for e in N.EDGES)
    out = _replaced(f"replace({out}, '\x01', ' ')", f"^[{edges}]+|[{edges}]+$", "")
    empty = ", ".join(_sql_text(w) for w in N.DEGENERATE)
    return rf"(SELECT CASE WHEN len(list_filter(regexp_split_to_array(v, '[\s-]+'), lambda w: w <> '' AND w NOT IN ({empty}))) = 0 THEN '' ELSE v END FROM (SELECT {out} AS v))"


def _sql_key(c: str) -> str:
    """SQL of ``names.match_key``."""
    out = f"strip_accents(lower(coalesce({c}, '')))"
    for pattern, to in N.SPELLINGS:
        out = _replaced(out, pattern, to.replace("$1", r"\1"))
    return f"trim({_replaced(out, ' +', ' ')})"


_NAMES = f"typed AS MATERIALIZED (SELECT raw, {_sql_clean('raw')} AS name FROM (SELECT DISTINCT trim(nr) AS raw FROM hadith WHERE nr IS NOT NULL)), keyed AS MATERIALIZED (SELECT raw, name, {_sql_key('name')} AS key FROM typed WHERE length(name) >= 3)"


@query(f"WITH {_NAMES} SELECT raw, name, key FROM keyed WHERE length(key) >= 3")
def narrator_names(spark, folder):
    """The bare name in every narrator field that names somebody, and the key it is matched by."""
    return _named(spark, folder).select("raw", "name", "key").distinct()


_LATIN_PART = r"trim(regexp_replace(regexp_replace(coalesce(name, ''), '(?s)[\x{0600}-\x{06FF}].*$', ''), '[\s(]+$', ''))"
_ARABIC_PART = r"trim(regexp_extract(coalesce(name, ''), '([\x{0600}-\x{06FF}][^(]*)', 1))"


@query(f"SELECT scholar_indx, {_LATIN_PART} AS en, {_ARABIC_PART} AS ar, {_sql_key(_LATIN_PART)} AS key FROM kaggle_rawis")
def biography_names(spark, folder):
    """The name of every biography in either script, and the key it is matched by."""
    en = N.latin_part(F.col("name"))
    return table(spark, folder, "kaggle_rawis").select("scholar_indx", en.alias("en"), N.arabic_part(F.col("name")).alias("ar"), N.match_key(en).alias("key"))


def _named(spark: SparkSession, folder: str) -> DataFrame:
    return people.named(table(spark, folder, "hadith"), "row_id", "nr", "s", "t", "g")


@query(f"WITH {_NAMES} SELECT key, count(*) AS n, min(row_id) AS first_ord FROM hadith JOIN keyed ON trim(hadith.nr) = keyed.raw WHERE length(key) >= 3 GROUP BY 1")
def people_clusters(spark, folder):
    return people.clusters(_named(spark, folder))


#: Short forms merged in the order of frequency and first place, by a walk that carries what is merged so far and how sizes grew.
_FOLD = f"""cluster AS MATERIALIZED (SELECT key, count(*) AS n, min(row_id) AS first, list_filter(string_split(key, ' '), lambda w: w <> '') AS w FROM hadith JOIN keyed ON trim(hadith.nr) = keyed.raw WHERE length(key) >= 3 GROUP BY 1),
long AS (SELECT key, n, first, w, unnest(range(1, least(len(w) - 1, 3) + 1)) AS i FROM cluster WHERE len(w) > 1),
part AS (SELECT 'p' AS side, array_to_string(w[1:i], ' ') AS part, key, n, first FROM long UNION ALL SELECT 's', array_to_string(w[len(w) - i + 1:], ' '), key, n, first FROM long),
short AS MATERIALIZED (SELECT c.key, c.n, list(DISTINCT {{'k': p.key, 'n': p.n, 'f': p.first}}) AS ls, row_number() OVER (ORDER BY c.n DESC, c.first) AS i FROM cluster c JOIN part p ON p.part = c.key AND (p.side = 'p' OR c.w[1] IN ('ibn', 'bint'))
  WHERE len(c.w) <= 3 AND len(list_filter(c.w, lambda w: w NOT IN ({', '.join(map(_sql_text, N.DEGENERATE))}))) > 0 GROUP BY c.key, c.n, c.first),
walk(i, merged, targets, adds) AS (SELECT 0::BIGINT, []::VARCHAR[], []::VARCHAR[], []::BIGINT[] UNION ALL
  SELECT i, CASE WHEN ok THEN list_append(merged, key) ELSE merged END, CASE WHEN ok THEN list_append(targets, o[1].k) ELSE targets END, CASE WHEN ok THEN list_append(adds, size) ELSE adds END FROM (
  SELECT *, coalesce((len(o) = 1 OR (len(o) > 1 AND -o[1].m >= 3 * -o[2].m)) AND -o[1].m >= 0.4 * size, false) AS ok FROM (
  SELECT s.i, s.key, w.merged, w.targets, w.adds, s.n + coalesce(list_sum(list_transform(list_filter(range(1, len(w.targets) + 1), lambda j: w.targets[j] = s.key), lambda j: w.adds[j])), 0)::BIGINT AS size,
    list_sort(list_transform(list_filter(s.ls, lambda x: NOT list_contains(w.merged, x.k)), lambda x: {{'m': -(x.n + coalesce(list_sum(list_transform(list_filter(range(1, len(w.targets) + 1), lambda j: w.targets[j] = x.k), lambda j: w.adds[j])), 0)::BIGINT), 'f': x.f, 'k': x.k}})) AS o
  FROM walk w JOIN short s ON s.i = w.i + 1))),
step AS MATERIALIZED (SELECT unnest(merged) AS key, unnest(targets) AS target FROM (SELECT merged, targets FROM walk ORDER BY i DESC LIMIT 1)),
chase(key, goal) AS (SELECT key, target FROM step UNION SELECT c.key, s.target FROM chase c JOIN step s ON s.key = c.goal),
final AS MATERIALIZED (SELECT c.key, coalesce(e.goal, c.key) AS final FROM cluster c LEFT JOIN (SELECT key, goal FROM chase WHERE goal NOT IN (SELECT key FROM step)) e ON e.key = c.key)"""


@query(f"WITH RECURSIVE {_NAMES}, {_FOLD} SELECT key, final FROM final")
def people_short_forms(spark, folder):
    return people.merge_short_forms(people.clusters(_named(spark, folder)))


def _best(value: str, source: str, most: int | None, shown: str = "v") -> str:
    """SQL of the most frequent values of each person, earlier seen first among equals."""
    return (
        f"(SELECT key, string_agg({shown}, '; ' ORDER BY r) AS v FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY c DESC, o, v) AS r FROM (SELECT key, {value} AS v, count(*) AS c, min(ord) AS o FROM {source} GROUP BY 1, 2)) "
        f"WHERE v IS NOT NULL{f' AND r <= {most}' if most else ''} GROUP BY 1)"
    )


@query(
    f"""WITH RECURSIVE {_NAMES}, {_FOLD}, base AS MATERIALIZED (SELECT f.final AS key, h.row_id AS ord, k.name, trim(h.nr) AS raw, h.s AS collection, h.t, h.g FROM hadith h JOIN keyed k ON trim(h.nr) = k.raw JOIN final f ON f.key = k.key),
who AS (SELECT key, count(*) AS n, min(ord) AS first_ord, count(*) FILTER (g LIKE 'Sahih%') AS sahih FROM base GROUP BY 1 HAVING count(*) >= 3)
SELECT w.key, w.n, w.first_ord, w.sahih, coalesce(a.v, '') AS variants, coalesce(b.v, '') AS raw, coalesce(c.v, '') AS cols, coalesce(d.v, '') AS topics FROM who w
LEFT JOIN {_best("name", "base", 4)} a ON a.key = w.key LEFT JOIN {_best("raw", "base", None)} b ON b.key = w.key LEFT JOIN {_best("collection", "base", None, "v || '=' || c")} c ON c.key = w.key
LEFT JOIN {_best("topic", "(SELECT key, ord, unnest(t) AS topic FROM base)", 6)} d ON d.key = w.key"""
)
def people_rollup(spark, folder):
    """People with three narrations or more: spellings, collections and topics, most frequent first."""
    listed = lambda c: F.array_join(c, "; ").alias(c)
    cols = F.array_join(F.transform("cols", lambda x: F.concat(x["value"], F.lit("="), x["count"].cast("string"))), "; ").alias("cols")
    return people.people(_named(spark, folder)).select("key", "n", "first_ord", "sahih", listed("variants"), listed("raw"), cols, listed("topics"))


@query()
def people_index(spark, folder):
    out = people.people_index(_named(spark, folder), people.biographies(table(spark, folder, "kaggle_rawis")))
    return out.withColumn("cols", F.map_from_entries(F.transform("cols", lambda x: F.struct(x["value"], x["count"])))).withColumn("cols", F.to_json("cols"))


@query()
def people_summary(spark, folder):
    """Totals, refused biographies and the twenty people with most narrations."""
    index = stored(people.people_index(_named(spark, folder), people.biographies(table(spark, folder, "kaggle_rawis"))))
    return people.people_report(index, table(spark, folder, "hadith").count())


@query(f"WITH RECURSIVE {_NAMES}, {_FOLD}, who AS (SELECT f.final FROM hadith JOIN keyed ON trim(hadith.nr) = keyed.raw JOIN final f ON f.key = keyed.key GROUP BY 1 HAVING count(*) >= 3) SELECT row_id, trim(nr) AS nr FROM hadith JOIN keyed ON trim(hadith.nr) = keyed.raw JOIN final f ON f.key = keyed.key WHERE f.final IN (SELECT final FROM who)")
def narrator_rows(spark, folder):
    """Rows of the narrators of the people index, through the names as typed."""
    who = people.people(_named(spark, folder))
    raw = who.select(F.explode("raw").alias("nr")).distinct()
    return table(spark, folder, "hadith").withColumn("nr", F.trim("nr")).join(raw, "nr", "left_semi").select("row_id", "nr")


def _blank(c: str) -> str:
    return f"(CASE WHEN trim(coalesce({c}, '')) IN ('-', 'NA', 'nan', 'NaN', 'None') THEN '' ELSE trim(coalesce({c}, '')) END)"


def _generation(part: int) -> str:
    """SQL of ``names.generation``: 1 label, 2 rank, 3 and 4 the years."""
    cases = " ".join(f"WHEN regexp_matches(lower(grade), {_sql_text(g[0])}) THEN {_sql_text(g[1]) if part == 1 else g[part]}" for g in N.GENERATIONS)
    return f"(CASE {cases} ELSE {_sql_text(N.UNPLACED[0]) if part == 1 else N.UNPLACED[part - 1]} END)"


_YEAR = f"trunc(try_cast({_blank('death_date_hijri')} AS DOUBLE))"
_BIOGRAPHIES = f"""bio AS MATERIALIZED (SELECT * FROM (SELECT {_sql_key(_LATIN_PART)} AS key, {_blank('grade')} AS grade, CASE WHEN {_YEAR} BETWEEN 0 AND 1400 THEN {_YEAR}::INT END AS death_h, scholar_indx AS idx FROM kaggle_rawis) WHERE key <> ''),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY (death_h IS NOT NULL) DESC, try_cast(idx AS BIGINT) NULLS LAST, idx) AS r FROM bio) WHERE r = 1),
years AS (SELECT key, count(death_h) AS dated, count(DISTINCT death_h) AS years FROM bio GROUP BY 1),
sought AS MATERIALIZED (SELECT DISTINCT key FROM hadith JOIN keyed ON trim(hadith.nr) = keyed.raw WHERE length(key) >= 3), held AS MATERIALIZED (SELECT DISTINCT key FROM bio),
near AS (SELECT s.key, CASE WHEN bool_or(h.key = s.key) THEN s.key WHEN count(h.key) = 1 THEN min(h.key) END AS match, CASE WHEN bool_or(h.key = s.key) THEN 1 ELSE count(h.key) END AS matches FROM sought s LEFT JOIN held h ON h.key = s.key OR starts_with(h.key, s.key || ' ') GROUP BY 1),
found AS (SELECT n.key, n.matches, o.grade, o.death_h, y.dated, y.years FROM near n LEFT JOIN one o ON o.key = n.match LEFT JOIN years y ON y.key = n.match),
judged AS (SELECT key, CASE WHEN matches > 1 THEN matches || ' people share this name form' WHEN matches = 0 THEN 'not in the biography source'
  WHEN key IN ({', '.join(map(_sql_text, N.GENERIC))}) OR len(list_filter(string_split(key, ' '), lambda w: w NOT IN ('', 'ibn', 'bint', 'al', 'abd'))) < 2 THEN 'name too generic to identify one person'
  WHEN dated = 0 THEN 'no candidate carries a death year' WHEN years > 1 THEN dated || ' candidates disagree on the death year'
  WHEN NOT death_h BETWEEN {_generation(3)} AND {_generation(4)} THEN 'death ' || death_h || ' AH contradicts ''' || {_generation(1)} || ''' (' || {_generation(3)} || '-' || {_generation(4)} || ')'
  WHEN {_generation(1)} = 'Companion' AND death_h < 20 THEN 'death ' || death_h || ' AH too early for a prolific narrator' END AS reason FROM found)"""


@query(f"WITH {_NAMES}, {_BIOGRAPHIES} SELECT coalesce(reason, 'attached') AS reason, count(*) AS n FROM judged GROUP BY 1")
def biography_refusals(spark, folder):
    keys = people.clusters(_named(spark, folder))
    return people.pick_biography(keys, people.biographies(table(spark, folder, "kaggle_rawis"))).groupBy(F.coalesce("reason", F.lit("attached")).alias("reason")).agg(F.count("*").alias("n"))


@query(
    """WITH l AS (SELECT DISTINCT lower(trim(birth_place)) AS key FROM kaggle_rawis WHERE birth_place IS NOT NULL), r AS (SELECT DISTINCT lower(trim(death_place)) AS key FROM kaggle_rawis WHERE trim(death_place) <> ''),
p AS (SELECT l.key, r.key AS m FROM l LEFT JOIN r ON l.key = r.key OR (l.key <> '' AND starts_with(r.key, l.key || ' ')))
SELECT key, CASE WHEN bool_or(key = m) THEN key WHEN count(m) = 1 THEN min(m) END AS match, CASE WHEN bool_or(key = m) THEN 1 ELSE count(m) END AS matches FROM p GROUP BY 1"""
)
def prefix_unique_join(spark, folder):
    """Places of birth as they stand among the places of death, or the only longer name that begins with them."""
    rows = table(spark, folder, "kaggle_rawis")
    place = lambda c: rows.where(F.col(c).isNotNull()).select(F.lower(F.trim(c)).alias("key"))
    return people.unique_prefix(place("birth_place"), place("death_place"))


@query("SELECT scholar_indx, CASE WHEN trunc(try_cast(trim(death_date_hijri) AS DOUBLE)) BETWEEN 0 AND 1400 THEN trunc(try_cast(trim(death_date_hijri) AS DOUBLE))::INT::VARCHAR END AS death_h FROM kaggle_rawis")
def tolerant_years(spark, folder):
    return table(spark, folder, "kaggle_rawis").select("scholar_indx", X.tolerant_int(F.col("death_date_hijri")).cast("string").alias("death_h"))


@query(
    r"""SELECT gen, rank::INT AS rank, count(*) AS n FROM (SELECT CASE WHEN regexp_matches(g, 'comp\.|companion') THEN 'Companion' WHEN regexp_matches(g, 'taba''? tabi|succ\.') THEN 'Successor''s successor' WHEN regexp_matches(g, 'follower|tabi''') THEN 'Successor'
WHEN g LIKE '%3rd century%' THEN '3rd century AH' WHEN g LIKE '%4th century%' THEN '4th century AH' WHEN g LIKE '%rasool allah%' THEN 'The Prophet' ELSE 'Unplaced' END AS gen,
CASE WHEN regexp_matches(g, 'comp\.|companion') THEN 1 WHEN regexp_matches(g, 'taba''? tabi|succ\.') THEN 3 WHEN regexp_matches(g, 'follower|tabi''') THEN 2 WHEN g LIKE '%3rd century%' THEN 4 WHEN g LIKE '%4th century%' THEN 5 WHEN g LIKE '%rasool allah%' THEN 0 ELSE 9 END AS rank
FROM (SELECT lower(coalesce(grade, '')) AS g FROM kaggle_rawis)) GROUP BY 1, 2"""
)
def generation_bucket(spark, folder):
    g = N.generation(F.col("grade"))
    return table(spark, folder, "kaggle_rawis").select(g["label"].alias("gen"), g["rank"].alias("rank")).groupBy("gen", "rank").agg(F.count("*").alias("n"))


# ---- editions as files, and arrivals


#: Entries as they stand in edition files made of openiti; unnumbered ones get their id as number.
_PRINTED = f"printed AS MATERIALIZED (SELECT source_file, entry_id, coalesce(n, entry_id) AS n, {_flat('ar')} AS text, row_number() OVER (PARTITION BY source_file ORDER BY entry_id) AS ord FROM openiti WHERE source_file IS NOT NULL AND ar IS NOT NULL)"
_ENTRIES = f"{_PRINTED}, entry AS MATERIALIZED (SELECT source_file AS edition, 'numbered' AS dialect, ord, n, text FROM printed WHERE len(string_split(text, ' ')) >= 6)"


def _edition_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, size, raw`` of all editions, written as files in the numbered dialect and read again."""
    rows = table(spark, folder, "openiti").where("source_file is not null and ar is not null").select("source_file", "entry_id", "n", "ar")
    line = F.concat(F.lit("# "), F.coalesce("n", "entry_id").cast("string"), F.lit(" "), F.regexp_replace("ar", "\n", " "))
    heads = rows.select("source_file").distinct().select("source_file", F.posexplode(F.array(F.concat(F.lit("#META# file :: "), F.col("source_file")), F.lit(editions.HEADER_END))).alias("pos", "line"))
    lines = rows.select("source_file", F.col("entry_id").alias("pos"), line.alias("line"), F.lit(1).alias("part")).unionByName(heads.select("source_file", "pos", "line", F.lit(0).alias("part")))
    at = f"{checkpoint_dir(spark)}/editions-{uuid.uuid4().hex}"
    with cleaning(spark):
        lines.repartition("source_file").sortWithinPartitions("source_file", "part", "pos").select("source_file", F.col("line").alias("value")).write.partitionBy("source_file").text(at)
    return editions.read_editions(spark, at, "part-*")


def _edition_name(path: str):
    return F.regexp_extract(path, r"source_file=([^/]+)/", 1)


@query(f"WITH {_ENTRIES} SELECT * FROM entry")
def entries_split(spark, folder):
    """Entries of all editions."""
    return editions.entries(_edition_files(spark, folder)).withColumn("edition", _edition_name("edition")).withColumn("n", F.col("n").cast("long"))


@query(f"WITH {_ENTRIES} SELECT w.title AS work, arg_max(edition, e.n_entries) AS path, max(e.n_entries) AS n_entries FROM edition_works w JOIN (SELECT edition, count(*) AS n_entries FROM entry GROUP BY 1) e ON contains(lower(e.edition), lower(w.fragment)) GROUP BY 1")
def best_edition(spark, folder):
    """The edition of each work that has most entries."""
    files, works = _edition_files(spark, folder), table(spark, folder, "edition_works")
    paths = files.select("path").join(works.select(F.col("title").alias("work"), "fragment"), editions.is_edition(F.col("path"), F.col("fragment")))
    return editions.best_edition(files.join(paths, "path")).withColumn("path", _edition_name("path"))


_EXTRACTED = f"""{_PRINTED}, fit AS MATERIALIZED (SELECT title AS scope, ord, text, n FROM printed JOIN edition_works w ON contains(lower(printed.source_file), lower(w.fragment)) WHERE len(string_split(text, ' ')) >= 6),
sets AS MATERIALIZED (SELECT scope, ord, {_arabic('text')} AS tokens FROM fit WHERE {_ATTRIBUTED.replace(_norm('ar'), _norm('text')).replace('length(ar)', 'length(text)')})"""
# As _WALK, by scope and position.
_WALK_SCOPES = """node AS MATERIALIZED (SELECT scope, ord, row_number() OVER (ORDER BY scope, ord) AS i FROM (SELECT scope, a AS ord FROM edges UNION SELECT scope, b FROM edges)),
link AS MATERIALIZED (SELECT x.i AS a, y.i AS b FROM edges e JOIN node x ON x.scope = e.scope AND x.ord = e.a JOIN node y ON y.scope = e.scope AND y.ord = e.b),
before AS MATERIALIZED (SELECT n.i, list(e.a) FILTER (e.a IS NOT NULL) AS earlier FROM node n LEFT JOIN link e ON e.b = n.i GROUP BY 1),
walk(i, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT b.i, CASE WHEN list_has_any(coalesce(b.earlier, []), w.kept) THEN w.kept ELSE list_append(w.kept, b.i) END FROM walk w JOIN before b ON b.i = w.i + 1),
chosen AS MATERIALIZED (SELECT unnest(kept) AS i FROM (SELECT kept FROM walk ORDER BY i DESC LIMIT 1)),
merged AS MATERIALIZED (SELECT n.scope, n.ord, k.ord AS kept FROM (SELECT e.b, min(e.a) AS a FROM link e JOIN chosen c ON c.i = e.a WHERE e.b NOT IN (SELECT i FROM chosen) GROUP BY 1) m JOIN node n ON n.i = m.b JOIN node k ON k.i = m.a),
state AS MATERIALIZED (SELECT s.scope, s.ord, CASE WHEN len(s.tokens) < 5 THEN 'short' WHEN m.kept IS NOT NULL THEN 'merged' ELSE 'kept' END AS status, coalesce(m.kept, s.ord) AS kept FROM sets s LEFT JOIN merged m ON m.scope = s.scope AND m.ord = s.ord)"""


def _extracted(spark: SparkSession, folder: str):
    return extract(_edition_files(spark, folder), table(spark, folder, "edition_works"), table(spark, folder, "topic_lexicon"), EDITION)


@query(f"WITH RECURSIVE {_EXTRACTED}, {_ALL_EDGES}, {_WALK_SCOPES} SELECT s.scope AS title, s.ord, f.n, f.text, (SELECT count(*) FROM state m WHERE m.status = 'merged' AND m.scope = s.scope AND m.kept = s.ord) AS dups, 'Other Narrations' AS topics FROM state s JOIN fit f ON f.scope = s.scope AND f.ord = s.ord WHERE s.status = 'kept'")
def extract_rows(spark, folder):
    """Unique attributed narrations of all works, from their edition files. The lexicon here is English, so none has a topic."""
    return _extracted(spark, folder)[0].withColumn("topics", F.array_join("topics", "; ")).withColumn("n", F.col("n").cast("long"))


@query(
    f"WITH RECURSIVE {_EXTRACTED}, {_ALL_EDGES}, {_WALK_SCOPES} SELECT w.title, CASE WHEN p.c IS NULL THEN 'no file' ELSE 'built' END AS status, coalesce(p.c, 0) AS parsed, coalesce(s.a, 0) AS attributed, coalesce(s.u, 0) AS uniq FROM edition_works w "
    "LEFT JOIN (SELECT scope, count(*) AS c FROM fit GROUP BY 1) p ON p.scope = w.title LEFT JOIN (SELECT scope, count(*) AS a, count(*) FILTER (status = 'kept') AS u FROM state GROUP BY 1) s ON s.scope = w.title"
)
def extract_summary(spark, folder):
    return _extracted(spark, folder)[1].select("title", "status", "parsed", "attributed", "uniq")


@query("SELECT DISTINCT s, n, x FROM hadith")
def stream_first_deliveries(spark, folder):
    """What the collections delivered as a stream holds, without what was delivered again."""
    source = table(spark, folder, "hadith")
    stream = spark.readStream.schema(source.schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(_stream_folder(folder))
    return _drained(spark, first_deliveries(stream.select("row_id", "s", "n", "x", "loaded_at"), ["s", "n", "x"], "loaded_at")).select("s", "n", "x")


def _stream_folder(folder: str) -> str:
    """A streamed file source takes a folder or a glob, not the one file a table may be."""
    return f"{folder}/hadith.parque[t]"


def _drained(spark: SparkSession, stream: DataFrame) -> DataFrame:
    at = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    run = stream.writeStream.format("parquet").option("path", f"{at}/rows").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/rows")
