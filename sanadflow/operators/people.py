"""Narrators as people: clusters of one name, short forms merged into long ones, biographies."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sanadflow.functions.names import DEGENERATE, arabic_part, clean_name, generation, is_generic, latin_part, match_key, tokens
from sanadflow.functions.text import blank_markers, title_case, tolerant_int
from sanadflow.operators.graph import components
from sanadflow.plans.layout import spread, spread_by, stored


def named(df: DataFrame, ord_: str, narrator: str, collection: str, topics: str, grade: str) -> DataFrame:
    """``ord, raw, name, key, collection, topics, grade`` of every row whose narrator can be named.

    Cleaning a name takes some sixty patterns, so it is done once for each distinct one. The result is
    written once, in the shared folder: many counts read it."""
    rows = spread(df.select(ord_, narrator, collection, topics, grade)).select(F.col(ord_).alias("ord"), F.trim(narrator).alias("raw"), F.col(collection).alias("collection"), F.col(topics).alias("topics"), F.col(grade).alias("grade"))
    typed = spread_by(rows.select("raw").where("raw is not null").distinct(), "raw").withColumn("name", clean_name(F.col("raw"))).where(F.length("name") >= 3)
    typed = stored(typed.withColumn("key", match_key(F.col("name"))).where(F.length("key") >= 3))
    return stored(rows.join(typed, "raw").select("ord", "raw", "name", "key", "collection", "topics", "grade"))


def clusters(rows: DataFrame) -> DataFrame:
    """``key, n, first_ord`` of every name."""
    return rows.groupBy("key").agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"))


def expansions(keys: DataFrame, longest: int = 3) -> DataFrame:
    """``short, long``: names of up to three words, and the longer names that begin with all of them;
    or end with them, if the short one begins with ibn or bint. Found by joins on prefixes and suffixes."""
    words = keys.select("key", tokens(F.col("key")).alias("w"))
    short = words.where(F.size("w") <= longest).where(F.exists("w", lambda x: ~x.isin(*DEGENERATE))).select(F.col("key").alias("short"), F.col("w").alias("sw"))
    upto = F.when(F.size("w") > 1, F.sequence(F.lit(1), F.least(F.size("w") - 1, F.lit(longest)))).otherwise(F.array().cast("array<int>"))
    ends = words.withColumn("upto", upto).select(
        F.col("key").alias("long"),
        F.explode(F.concat(
            F.transform("upto", lambda i: F.struct(F.lit("p").alias("side"), F.array_join(F.slice("w", 1, i), " ").alias("part"))),
            F.transform("upto", lambda i: F.struct(F.lit("s").alias("side"), F.array_join(F.slice("w", F.size("w") - i + 1, i), " ").alias("part"))),
        )).alias("e"),
    ).select("long", "e.side", "e.part")
    relational = F.col("sw")[0].isin("ibn", "bint")
    return short.join(ends, F.col("short") == F.col("part")).where((F.col("side") == "p") | relational).select("short", "long").distinct()


def _fold(group: pd.DataFrame) -> pd.DataFrame:
    """Short forms of one group of related names, most frequent first, merged into their dominant expansion."""
    info = pd.concat([group[["short", "n_short", "first_short"]].set_axis(["key", "n", "first"], axis=1), group[["long", "n_long", "first_long"]].set_axis(["key", "n", "first"], axis=1)]).drop_duplicates("key")
    size, first = dict(zip(info.key, info.n, strict=True)), dict(zip(info.key, info["first"], strict=True))
    longer = group.groupby("short")["long"].agg(list).to_dict()
    into: dict[str, str] = {}
    for short in sorted(longer, key=lambda k: (-size[k], first[k])):
        open_ = sorted((k for k in longer[short] if k not in into), key=lambda k: (-size[k], first[k]))
        if not open_ or len(open_) > 1 and size[open_[0]] < 3 * size[open_[1]] or size[open_[0]] < 0.4 * size[short]:
            continue
        into[short] = open_[0]
        size[open_[0]] += size[short]
    ends = {}
    for k in into:
        end = k
        while end in into:
            end = into[end]
        ends[k] = end
    return pd.DataFrame({"key": list(ends), "final": list(ends.values())}, dtype=object)


def merge_short_forms(keys: DataFrame, group: int = 100_000) -> DataFrame:
    """``key, final`` for every name: the name it is merged into, itself if none.

    Sizes grow while names merge, so the order (frequency, then first place) matters; it is
    kept within each connected group of names, and groups do not touch one another.
    A short form goes to its only expansion if that has 0.4 of its size, or to one of several
    if it has three times the size of the next. Groups of up to ``group`` pairs are folded in one task each; larger
    ones, such as those that common first names hold together, in rounds over all tasks (:func:`_fold_in_rounds`).
    """
    edges = stored(expansions(keys))
    # So few pairs that one task may hold them all need not be told apart first.
    few = edges.count() <= group
    groups = edges.select("short", F.lit("").alias("component")).distinct() if few else components(edges, "short", "long").withColumnRenamed("node", "short")
    sides = [keys.select(F.col("key").alias(x), F.col("n").alias(f"n_{x}"), F.col("first_ord").alias(f"first_{x}")) for x in ("short", "long")]
    rows = stored(edges.join(sides[0], "short").join(sides[1], "long").join(groups, "short"))
    if few:
        merged = rows.groupBy("component").applyInPandas(_fold, "key string, final string")
        return keys.select("key").join(merged, "key", "left").select("key", F.coalesce("final", "key").alias("final"))
    large = rows.groupBy("component").agg(F.count("*").alias("pairs")).where(F.col("pairs") > group).select("component")
    merged = rows.join(large, "component", "left_anti").groupBy("component").applyInPandas(_fold, "key string, final string")
    rest = rows.join(large, "component", "left_semi")
    if not large.isEmpty():
        merged = merged.unionByName(_fold_in_rounds(rest))
    return keys.select("key").join(merged, "key", "left").select("key", F.coalesce("final", "key").alias("final"))


def _fold_in_rounds(rows: DataFrame) -> DataFrame:
    """``key, final`` of the merged short forms, as :func:`_fold` has them, without a task for a whole group.

    A short form waits for the earlier ones that could change what it sees: those that share an expansion with it
    (at most six short forms have one), those that are its expansions, and those of which it is one.
    In each round all that wait for nobody are decided at once.
    """
    edges = stored(rows.select("short", "long"))
    sides = [rows.select(F.col(x).alias("key"), F.col(f"n_{x}").alias("size"), F.col(f"first_{x}").alias("first")) for x in ("short", "long")]
    size = stored(sides[0].unionByName(sides[1]).distinct())
    rank = size.join(edges.select(F.col("short").alias("key")).distinct(), "key").select("key", F.struct((-F.col("size")).alias("m"), "first", "key").alias("rank"))
    x, y = (edges.select(F.col("short").alias(n), "long") for n in ("s", "t"))
    touch = x.join(y, "long").select("s", "t").union(edges.select(F.col("short").alias("s"), F.col("long").alias("t"))).union(edges.select(F.col("long").alias("s"), F.col("short").alias("t")))
    waits = touch.where("s <> t").distinct().join(rank.select(F.col("key").alias("s"), F.col("rank").alias("r_s")), "s").join(rank.select(F.col("key").alias("t"), F.col("rank").alias("r_t")), "t")
    waits = stored(waits.where("r_t < r_s").select("s", "t"))
    open_ = stored(rank.select("key"))
    into = rows.sparkSession.createDataFrame([], "key string, target string")
    while not open_.isEmpty():
        ready = stored(open_.join(waits.join(open_.select(F.col("key").alias("t")), "t", "left_semi").select(F.col("s").alias("key")), "key", "left_anti"))
        mine = edges.join(ready.select(F.col("key").alias("short")), "short", "left_semi").join(into.select(F.col("key").alias("long")), "long", "left_anti")
        seen = mine.join(size.select(F.col("key").alias("long"), F.struct((-F.col("size")).alias("m"), "first", F.col("key").alias("k")).alias("v")), "long")
        best = seen.groupBy("short").agg(F.min("v").alias("one"))
        second = seen.join(best, "short").where(F.col("v") != F.col("one")).groupBy("short").agg(F.min("v.m").alias("two"))
        own = size.select(F.col("key").alias("short"), "size")
        chosen = best.join(second, "short", "left").join(own, "short")
        chosen = chosen.where((F.col("two").isNull() | (-F.col("one.m") >= -3 * F.col("two"))) & (-F.col("one.m") >= 0.4 * F.col("size")))
        chosen = stored(chosen.select(F.col("short").alias("key"), F.col("one.k").alias("target"), "size"))
        grown = chosen.groupBy(F.col("target").alias("key")).agg(F.sum("size").alias("more"))
        size = stored(size.join(grown, "key", "left").select("key", (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"), "first"))
        into = stored(into.unionByName(chosen.select("key", "target")))
        open_ = stored(open_.join(ready, "key", "left_anti"))
    at = into.select("key", F.col("target").alias("final"))
    while True:
        onward = at.select(F.col("key").alias("final"), F.col("final").alias("end"))
        further = at.join(onward, "final", "left")
        if further.where("end is not null").isEmpty():
            return at
        at = stored(further.select("key", F.coalesce("end", "final").alias("final")))


def rollup(rows: DataFrame, support: int = 3) -> DataFrame:
    """One row a person with at least ``support`` narrations: ``key, n, first_ord, name, variants`` (4),
    ``raw`` (all), ``cols`` and ``topics`` (6), most frequent first, earlier seen first among equals, and ``sahih``, the sound ones."""
    # Every row gives one fact of each kind and one of each of its topics; facts are counted before they meet by person.
    one = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    facts = F.array(one("row", F.when(F.col("grade").startswith("Sahih"), F.lit("sahih")).otherwise(F.lit(""))), *(one(c, F.col(c)) for c in ("name", "raw", "collection")))
    facts = F.concat(facts, F.transform(F.coalesce("topics", F.array().cast("array<string>")), lambda t: one("topic", t)))
    counted = rows.select("key", "ord", F.explode(facts).alias("f")).groupBy("key", "f.kind", "f.value").agg(F.count("*").alias("c"), F.min("ord").alias("o"))
    row = F.col("kind") == "row"
    ranked = lambda kind: F.array_sort(F.collect_list(F.when((F.col("kind") == kind) & F.col("value").isNotNull(), F.struct((-F.col("c")).alias("m"), "o", "value"))))
    out = counted.groupBy("key").agg(
        F.sum(F.when(row, F.col("c"))).alias("n"), F.min(F.when(row, F.col("o"))).alias("first_ord"), F.coalesce(F.sum(F.when(row & (F.col("value") == "sahih"), F.col("c"))), F.lit(0)).alias("sahih"),
        *(ranked(kind).alias(name) for kind, name in (("name", "_names"), ("raw", "_raw"), ("collection", "_cols"), ("topic", "_topics"))),
    ).where(F.col("n") >= support)
    cols = F.transform("_cols", lambda x: F.struct(x["value"].alias("value"), (-x["m"]).alias("count")))
    return out.select("key", "n", "first_ord", title_case(F.get("_names", F.lit(0))["value"]).alias("name"), _values("_names", 4).alias("variants"), _values("_raw").alias("raw"), cols.alias("cols"), _values("_topics", 6).alias("topics"), "sahih")


def _values(column: str, most: int | None = None) -> Column:
    every = F.coalesce(F.transform(column, lambda x: x["value"]), F.array().cast("array<string>"))
    return F.slice(every, 1, most) if most else every


def people(rows: DataFrame, support: int = 3) -> DataFrame:
    """:func:`rollup` after :func:`merge_short_forms`."""
    final = merge_short_forms(stored(clusters(rows)))
    return rollup(rows.join(final, "key").drop("key").withColumnRenamed("final", "key"), support)


def biographies(df: DataFrame) -> DataFrame:
    """``key, en, ar, grade, death_h, death_g, birth_place, death_place, idx`` of biographies as delivered."""
    en = latin_part(F.col("name"))
    rows = df.select(match_key(en).alias("key"), en.alias("en"), arabic_part(F.col("name")).alias("ar"), *[blank_markers(F.col(c)).alias(c) for c in ("grade", "birth_place", "death_place")], tolerant_int(blank_markers(F.col("death_date_hijri"))).alias("death_h"), tolerant_int(blank_markers(F.col("death_date_gregorian")), -(2**31), 2**31 - 1).alias("death_g"), F.col("scholar_indx").alias("idx"))
    return stored(rows.where("key <> ''"))


def unique_prefix(left: DataFrame, right: DataFrame) -> DataFrame:
    """``key, match, matches``: for each distinct key of ``left`` the equal key of ``right``, or else the only
    one that begins with all of its words; ``matches`` is how many do, ``match`` is null unless it is one.
    Keys without either have ``matches`` 0. An equi-join on prefixes, not a scan for each key."""
    keys = right.select("key").distinct()
    words = tokens(F.col("key"))
    prefixes = keys.select(F.col("key").alias("match"), F.explode(F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, 1, i), " "))).alias("prefix")).where("match <> ''")
    mine = left.select("key").distinct()
    found = mine.join(prefixes, F.col("key") == F.col("prefix"), "left").groupBy("key").agg(F.max(F.col("key") == F.col("match")).alias("equal"), F.count("match").alias("n"), F.min("match").alias("first"))
    equal = F.coalesce("equal", F.lit(False))
    return found.select("key", F.when(equal, F.col("key")).when(F.col("n") == 1, F.col("first")).alias("match"), F.when(equal, 1).otherwise(F.col("n")).alias("matches"))


def pick_biography(keys: DataFrame, bios: DataFrame) -> DataFrame:
    """``key``, the biography's columns, and ``reason`` where none is attached.

    Refused, in this order: several people share the form; none in the source; the name is
    too generic; no candidate has a death year; the years disagree; the year does not fit
    the generation; a Companion dead before 20. Of several candidates of one year the first
    by ``idx`` is taken, as a number where it is one.
    """
    own = [c for c in bios.columns if c != "key"]
    held = bios.withColumn("_dated", F.col("death_h").isNotNull())
    first = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("_dated"), F.col("idx").try_cast("long").asc_nulls_last(), "idx"))
    one = held.withColumn("_r", first).where("_r = 1").drop("_r", "_dated")
    years = bios.groupBy("key").agg(F.count("death_h").alias("_dated"), F.count_distinct("death_h").alias("_years"))
    found = unique_prefix(keys, bios).join(one.join(years, "key").withColumnRenamed("key", "match"), "match", "left")
    g = generation(F.col("grade"))
    year = F.col("death_h").cast("string")
    reason = F.when(F.col("matches") > 1, F.concat(F.col("matches").cast("string"), F.lit(" people share this name form")))
    reason = reason.when(F.col("matches") == 0, "not in the biography source").when(is_generic(F.col("key")), "name too generic to identify one person")
    reason = reason.when(F.col("_dated") == 0, "no candidate carries a death year").when(F.col("_years") > 1, F.concat(F.col("_dated").cast("string"), F.lit(" candidates disagree on the death year")))
    reason = reason.when(~F.col("death_h").between(g["low"], g["high"]), F.concat(F.lit("death "), year, F.lit(" AH contradicts '"), g["label"], F.lit("' ("), g["low"].cast("string"), F.lit("-"), g["high"].cast("string"), F.lit(")")))
    reason = reason.when((g["label"] == "Companion") & (F.col("death_h") < 20), F.concat(F.lit("death "), year, F.lit(" AH too early for a prolific narrator")))
    return found.withColumn("reason", reason).select("key", *[F.when(F.col("reason").isNull(), F.col(c)).alias(c) for c in own], "reason")


def people_index(rows: DataFrame, bios: DataFrame, support: int = 3) -> DataFrame:
    """People with their biographies, the dated ones first by year, then by generation and size."""
    who = people(rows, support)
    out = who.join(pick_biography(who, bios), "key").withColumn("_g", generation(F.col("grade")))
    place = F.coalesce(F.nullif("birth_place", F.lit("")), F.nullif("death_place", F.lit("")), F.lit(""))
    out = out.withColumn("name", F.coalesce(F.nullif("en", F.lit("")), F.col("name"))).withColumn("place", place).withColumn("gen", F.col("_g.label")).withColumn("rank", F.col("_g.rank"))
    out = out.select("key", "name", F.coalesce("ar", F.lit("")).alias("ar"), "n", "cols", "topics", "sahih", "death_h", "death_g", "gen", "rank", "place", F.when(F.col("reason").isNull(), "biographies").alias("bio_source"), "variants", "raw", "first_ord", "reason")
    return out.orderBy(F.col("death_h").asc_nulls_last(), "rank", F.desc("n"), "first_ord")


def people_report(index: DataFrame, rows: int, top: int = 20) -> DataFrame:
    """``part, place, label, n``: totals of an index over ``rows`` rows, why biographies were refused, and the ``top`` people by narrations."""
    sums = index.agg(F.count("*").alias("people"), F.count("bio_source").alias("with a biography"), F.count("death_h").alias("with a death year"), F.coalesce(F.sum("n"), F.lit(0)).alias("narrations covered"))
    names = ("people", "with a biography", "with a death year", "narrations covered")
    totals = sums.select(F.posexplode(F.array(*[F.struct(F.lit(x).alias("label"), F.col(x).cast("long").alias("n")) for x in names], F.struct(F.lit("narrations").alias("label"), F.lit(rows).cast("long").alias("n")))).alias("place", "e"))
    refused = index.where("reason is not null").groupBy(F.col("reason").alias("label")).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "label")) - 1
    label = F.concat_ws("  ", F.coalesce(F.concat(F.lit("d."), F.col("death_h").cast("string"), F.lit("H")), F.lit("-")), "gen", F.substring("name", 1, 46))
    best = index.orderBy(F.desc("n"), "first_ord").limit(top).select(label.alias("label"), "n", "first_ord").withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "first_ord")) - 1)
    return totals.select(F.lit("totals").alias("part"), "place", "e.label", "e.n").unionByName(refused.select(F.lit("refused").alias("part"), rank.alias("place"), "label", "n")).unionByName(best.select(F.lit("top").alias("part"), "place", "label", "n"))
