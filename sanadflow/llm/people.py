"""Names of one person under many spellings (problem 5) and their biographies (problem 3)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sanadflow.llm.names import EQUAL, INITIAL, NEAR, OTHER, Name, initial_keys, keys, levels, parse, year_of
from sanadflow.operators.graph import components
from sanadflow.operators.pairs import expand_pairs
from sanadflow.plans.layout import by_true_size, spread_by, stored

ARABIC = re.compile("[\u0600-\u06ff\ufb50-\ufdff\ufe70-\ufeff]")
PARTS = ["kunya", "given", "father", "origin", "byname", "year"]
_PART_TYPES = "kunya string, given string, father string, origin string, byname string, year int"
_STRINGS = [(c, pa.string()) for c in PARTS[:5]] + [("year", pa.int32())]


def _columns(names: list[Name]) -> list[pa.Array]:
    return [pa.array([n[i] for n in names], kind) for i, (_, kind) in enumerate(_STRINGS)]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [parse(x) for x in batch.column("value").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("value"), batch.column("n"), *_columns(names)], names=["value", "n", *PARTS])


def _keys(asked: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = map(Name, *(batch.column(c).to_pylist() for c in PARTS))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([keys(n) + initial_keys(n, asked) for n in names], pa.list_(pa.string()))], names=["id", "keys"])

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (map(Name, *(batch.column(f"{c}_{x}").to_pylist() for c in PARTS)) for x in "ab")
        found = [levels(x, y) for x, y in zip(a, b, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("id_a"), batch.column("id_b"), *(pa.array([x[i] for x in found], pa.int8()) for i in range(6))], names=["id_a", "id_b", *(f"l_{c}" for c in PARTS)])


def parsed(df: DataFrame, column: str) -> DataFrame:
    """``value, n`` and the parts of every distinct value of ``column`` but null."""
    values = df.select(F.col(column).alias("value")).where("value is not null").groupBy("value").agg(F.count("*").alias("n"))
    return stored(spread_by(values, "value").mapInArrow(_parse, f"value string, n long, {_PART_TYPES}"))


def forms(values: DataFrame) -> DataFrame:
    """``id, n`` and the parts of every distinct combination of parts that says enough to block on: two whole
    parts, or one and an initial."""
    rows = values.groupBy(*PARTS).agg(F.count("*").alias("n")).withColumn("id", _form_id())
    whole, held = (sum(F.when(F.length(c) > least, 1).otherwise(0) for c in PARTS[:5]) for least in (1, 0))
    return stored(rows.where((whole >= 2) | (whole == 1) & (held >= 2)))


def _form_id():
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in PARTS])


def compared(left: DataFrame, right: DataFrame) -> DataFrame:
    """``id_a, id_b`` and the level of agreement of each part, for all pairs of forms that share a key; a name
    of one part and an initial looks on the left for the names it may stand for on the right."""
    a = left.mapInArrow(_keys(True), "id string, keys array<string>").select(F.col("id").alias("id_a"), F.explode("keys").alias("key"))
    b = right.mapInArrow(_keys(False), "id string, keys array<string>").select(F.col("id").alias("id_b"), F.explode("keys").alias("key"))
    pairs = a.join(b, "key").select("id_a", "id_b").where("id_a <> id_b").distinct()
    for x, side in (("a", left), ("b", right)):
        pairs = pairs.join(side.select(*[F.col(c).alias(f"{c}_{x}") for c in ("id", *PARTS)]), f"id_{x}")
    wanted = pairs.select("id_a", "id_b", *[f"{c}_{x}" for x in "ab" for c in PARTS])
    return stored(wanted.mapInArrow(_compare, "id_a string, id_b string, " + ", ".join(f"l_{c} tinyint" for c in PARTS)))


@dataclass(frozen=True)
class Channel:
    """Noisy channel. Learned from the data: how often a name has a typing error (from ``error`` on, in
    ``rounds`` of expectation-maximisation), how often each part is written, as an initial or in full. Given:
    chance that a name is one which no other family bears, chance that a part is new to its person, weight
    of a person who is not in the data, and posterior from which an abbreviation is attached."""

    error: float = 0.05
    rounds: int = 2
    unseen: float = 1e-6
    added: float = 0.3
    stranger: float = 1e-7
    sure: float = 0.9


def _count(*levels_: int):
    return sum(F.when(F.col(f"l_{c}").isin(*levels_), 1).otherwise(0) for c in PARTS)


EDITS = ("swap", "left out", "doubled", "added", "changed")


def _edit(typed, meant):
    """``kind`` of the one edit between two names, and in how many ways it could have been made of ``meant``."""
    letters = lambda c: F.array_sort(F.split(c, ""))
    single = lambda c: F.regexp_replace(c, "(.)\\1+", "$1")
    size = F.length(meant)
    kinds = [(F.length(typed) < size, 1, size), ((F.length(typed) > size) & (single(typed) == single(meant)), 2, size), (F.length(typed) > size, 3, 25 * (size + 1)), (letters(typed) == letters(meant), 0, size - 1)]
    out = None
    for test, kind, ways in kinds:
        one = F.struct(F.lit(kind).alias("kind"), ways.cast("double").alias("ways"))
        out = F.when(test, one) if out is None else out.when(test, one)
    return out.otherwise(F.struct(F.lit(4).alias("kind"), (25 * size).cast("double").alias("ways")))


def persons(values: DataFrame, channel: Channel = Channel()) -> DataFrame:
    """``value, person`` for every value that names one person.

    Names are attached to the form of the greatest posterior, prior times likelihood of the noisy
    channel. Among names of one shape (first name with father and origin, with father, with
    origin) the prior is frequency and the channel types errors (:func:`_attached`). A shorter name is an
    abbreviation of any person that has all its parts, all persons being equally probable beforehand; the channel leaves parts
    out, makes initials and types errors (:func:`_abbreviated`). A name that fits several persons about equally stays
    out, unless a year, a byname or a kunya makes it one person's; a name that fits none is a person of its own,
    with its misspellings. A byname, kunya, father or origin that stands alone is the one person's who shows it
    (:func:`_alone`).
    """
    with by_true_size(values.sparkSession):
        rows = forms(values)
        pairs = compared(rows, rows)
        whole = lambda c: F.length(c) > 1
        shape = F.when(whole("given") & whole("father") & whole("origin"), "T").when(whole("given") & whole("father") & (F.col("origin") == ""), "D")
        shape = shape.when(whole("given") & whole("origin") & (F.col("father") == ""), "G").otherwise("O")
        kind = rows.select("id", "n", "year", *PARTS[:5], shape.alias("kind"))

        own, error = _attached(kind.where("kind <> 'O'"), pairs, channel)
        shown = _shown(rows)
        known = kind.where("kind = 'T'").join(own, "id").select("id", "person", "year", *PARTS[:5])
        agree = _count(NEAR, EQUAL, INITIAL) - F.when(F.col("l_year") > OTHER, 1).otherwise(0)
        fit = stored(pairs.where((_count(OTHER) == 0) & (agree >= 2)))
        telling = F.col("year").isNotNull() | (F.col("byname") != "") | (F.col("kunya") != "")
        for step in "DGO":
            asked = kind.where(F.col("kind") == step)
            found = _abbreviated(asked, known, fit, shown, error, channel)
            left = asked.join(own.withColumnRenamed("person", "alone"), "id", "left").join(found, "id", "left")
            choice = F.when(F.col("posterior") >= channel.sure, F.col("person")).when(F.col("posterior").isNull(), F.coalesce("alone", "id")).when(telling & (F.lit(step) != "O"), F.col("id"))
            known = stored(known.unionByName(left.select("id", choice.alias("person"), "year", *PARTS[:5]).where("person is not null")))
        named = values.withColumn("id", _form_id()).join(known, "id").select("value", "person")
        single = _single(values)
        return stored(named if single.isEmpty() else named.unionByName(_alone(single, known)))


#: Parts that stand for a person when they stand alone, and what they are looked up as: 'al-X' may be an origin or a byname.
ALONE = {"kunya": "kunya", "father": "father", "origin": "al", "byname": "al"}


def _single(values: DataFrame) -> DataFrame:
    """``value, role, part, year`` of the values that are nothing but one of ``ALONE``, too little for :func:`forms`."""
    held = sum(F.when(F.length(c) > 0, 1).otherwise(0) for c in PARTS[:5])
    part = lambda of: F.coalesce(*[F.when(F.length(c) > 1, of(c)) for c in ALONE])
    return values.where(held == 1).select("value", part(lambda c: F.lit(ALONE[c])).alias("role"), part(F.col).alias("part"), "year").where("part is not null")


def _alone(single: DataFrame, known: DataFrame) -> DataFrame:
    """``value, person``: parts that stand alone, with the only person whose names show them and whose years allow theirs.
    What nobody or more than one person shows stays out; equal parts are looked up once."""
    shows = known.select("person", F.explode(F.array(*[F.struct(F.lit(role).alias("role"), F.col(c).alias("part")) for c, role in ALONE.items()])).alias("e")).select("person", "e.*").where("part <> ''").distinct()
    years = known.where("year is not null").groupBy("person").agg(F.min("year").alias("y0"), F.max("year").alias("y1"))
    cand = single.select("role", "part", "year").distinct().join(shows, ["role", "part"]).join(years, "person", "left")
    cand = cand.where("year is null or y0 is null or year between y0 - 1 and y1 + 1")
    one = cand.groupBy("role", "part", "year").agg(F.count("*").alias("many"), F.first("person").alias("person")).where("many = 1").withColumnRenamed("year", "_y").drop("many")
    return single.join(one, ["role", "part"]).where(F.col("year").eqNullSafe(F.col("_y"))).select("value", "person")


def _shown(rows: DataFrame) -> dict[str, tuple[float, float]]:
    """How often a part is written in full and as an initial, in all rows."""
    sums = [F.sum(F.when(test(F.length(c)), F.col("n"))).alias(f"{k}_{c}") for c in PARTS[:5] for k, test in (("w", lambda x: x > 1), ("i", lambda x: x == 1))]
    r = rows.agg(F.sum("n").alias("all"), *sums).first()
    rate = lambda x: min(max((x or 0) / (r["all"] or 1), 1e-3), 0.99)
    return {c: (rate(r[f"w_{c}"]), rate(r[f"i_{c}"])) for c in PARTS[:5]}


def _abbreviated(asked: DataFrame, known: DataFrame, fit: DataFrame, shown, error: float, channel: Channel) -> DataFrame:
    """``id, person, posterior``: the most probable person of each name of ``asked`` that fits any.

    A person's likelihood is that of the best of its forms. For each part the form has, the name has it in
    full, misspelt, as an initial or not at all; a part that only the name has is new to the person.
    """
    years = known.where("year is not null").groupBy("person").agg(F.min("year").alias("y0"), F.max("year").alias("y1"))
    cand = fit.join(asked.select(F.col("id").alias("id_a"), "year", *[F.col(c).alias(f"{c}_a") for c in PARTS[:5]]), "id_a")
    cand = cand.join(known.select(F.col("id").alias("id_b"), "person", *[F.col(c).alias(f"{c}_b") for c in PARTS[:5]]), "id_b").join(years, "person", "left")
    cand = cand.where("year is null or y0 is null or year between y0 - 1 and y1 + 1")
    like = F.lit(0.0)
    for c in PARTS[:5]:
        full, initial = shown[c]
        left_out = max(1 - full - initial, 1e-3)
        one = F.when((F.col(f"{c}_a") == "") & (F.col(f"{c}_b") == ""), 1.0).when(F.col(f"{c}_b") == "", full * channel.added).when(F.col(f"{c}_a") == "", left_out)
        one = one.when(F.col(f"l_{c}") == INITIAL, initial).when(F.col(f"l_{c}") == NEAR, full * error / (5 * F.length(f"{c}_b"))).otherwise(full * (1 - error))
        like = like + F.log(one)
    each = cand.groupBy("id_a", "person").agg(F.max(like).alias("l"))
    # A stranger would show the same parts.
    seen = sum(F.when(F.length(c) > 1, float(np.log(shown[c][0]))).when(F.length(c) == 1, float(np.log(shown[c][1]))).otherwise(0.0) for c in PARTS[:5])
    stranger = asked.select(F.col("id").alias("id_a"), (seen + float(np.log(channel.stranger))).alias("s"))
    best = each.groupBy("id_a").agg(F.max_by("person", F.struct("l", "person")).alias("person"), F.max("l").alias("top"), F.sum(F.exp("l")).alias("sum"))
    return best.join(stranger, "id_a").select(F.col("id_a").alias("id"), "person", (F.exp("top") / (F.col("sum") + F.exp("s"))).alias("posterior"))


def _attached(forms_: DataFrame, pairs: DataFrame, channel: Channel) -> tuple[DataFrame, float]:
    """``id, person``: names attached to their most probable spelling among names of one shape; and the rate of errors.

    Candidates of a name are itself and the names one edit away in one part that are more probable
    beforehand. Its own weight is its prior times the chance that its odd part is a name in its own right, which
    is how many families bear it, as far as these do not go elsewhere themselves; a candidate's weight is its prior times the chance of this error. Priors are
    frequencies at first, those of names of other shapes that agree with it included, then the expected frequency of all that is attached, so that a spelling in the middle of its
    misspellings gains. Each name goes to its maximum posterior, and with it to where that one goes.
    Names that differ only in kunya, byname or year are one name here.
    """
    parts = ["given", "father", "origin"]
    names = stored(forms_.withColumn("name", F.concat_ws("|", *parts)).groupBy("name", "kind", *parts).agg(F.sum("n").cast("double").alias("n")))
    names = stored(names.join(_support(names), "name", "left").withColumn("support", F.coalesce("support", F.lit(0.0))))
    named = forms_.select("id", F.concat_ws("|", *parts).alias("name"))
    count = lambda *of: sum(F.when(F.col(f"l_{c}").isin(*of), 1).otherwise(0) for c in parts)
    odd = F.coalesce(*[F.when(F.col(f"l_{c}") == NEAR, F.lit(c)) for c in parts])
    near = pairs.where((count(NEAR) == 1) & (count(OTHER, INITIAL) == 0)).select("id_a", "id_b", odd.alias("odd"))
    a, b = (forms_.select(F.col("id").alias(f"id_{x}"), F.concat_ws("|", *parts).alias(x), "kind") for x in "ab")
    near = near.join(a, "id_a").join(b, ["id_b", "kind"]).select("a", "b", "odd", "kind").distinct()
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("odd"), F.col(c).alias("part"), F.concat_ws("|", *[x for x in parts if x != c]).alias("rest")) for c in parts])).alias("e")
    bearers = names.select("name", "kind", each).select("name", "kind", "e.odd", "e.part")
    total = names.groupBy("kind").agg(F.count("*").alias("all"))
    part = F.coalesce(*[F.when(F.col("odd") == c, F.col(c)) for c in parts])
    scored = near
    for x, name in (("a", "part"), ("b", "meant")):
        scored = scored.join(names.select(F.col("name").alias(x), *parts), x).withColumn(name, part).drop(*parts)
    scored = scored.join(F.broadcast(total), "kind").withColumn("e", _edit(F.col("part"), F.col("meant")))
    scored = stored(scored.select("a", "b", "kind", "odd", "part", "all", F.col("e.kind").alias("edit"), F.col("e.ways").alias("ways")))
    priors, rates = names.select("name", "n", (F.col("n") + F.col("support")).alias("prior"), F.lit(1.0).alias("stays")), [channel.error / len(EDITS)] * len(EDITS)
    rows = names.agg(F.sum("n")).first()[0] or 1.0
    best = None
    for last in range(channel.rounds + 1):
        x, y = (priors.select(F.col("name").alias(k), F.col("prior").alias(f"p_{k}"), F.col("n").alias(f"n_{k}"), F.col("stays").alias(f"s_{k}")) for k in "ab")
        families = bearers.join(priors.select("name", "stays"), "name").groupBy("kind", "odd", "part").agg(F.sum("stays").alias("families"))
        weighed = scored.join(families, ["kind", "odd", "part"]).join(x, "a").withColumn("genuine", F.greatest(F.col("families") - F.col("s_a"), F.lit(0.0)) / F.col("all") + channel.unseen)
        weighed = weighed.join(y, "b").where(F.struct("p_b", "n_b", "b") > F.struct("p_a", "n_a", "a"))
        rate = F.array(*map(F.lit, rates))[F.col("edit")]
        weighed = weighed.select("a", "b", "n_a", "edit", (F.col("p_b") * rate / F.col("ways")).alias("w"), (F.col("p_a") * F.col("genuine")).alias("own"))
        if last == channel.rounds:
            best = weighed.where("w > own").groupBy(F.col("a").alias("name")).agg(F.max_by("b", F.struct("w", "b")).alias("to"))
            break
        # A name's odd part depends on the candidate; the least chance of being genuine stands for it.
        whole = weighed.groupBy("a").agg(F.sum("w").alias("sum"), F.min("own").alias("self"))
        moved = weighed.join(whole, "a").select("a", "b", "edit", (F.col("n_a") * F.col("w") / (F.col("sum") + F.col("self"))).alias("m"))
        moved = stored(moved)
        change = moved.select(F.explode(F.array(F.struct(F.col("a").alias("name"), (-F.col("m")).alias("m")), F.struct(F.col("b").alias("name"), "m"))).alias("c")).groupBy("c.name").agg(F.sum("c.m").alias("change"))
        gone = moved.groupBy(F.col("a").alias("name")).agg(F.sum("m").alias("gone"))
        stays = 1 - F.coalesce("gone", F.lit(0.0)) / F.col("n")
        priors = stored(names.join(change, "name", "left").join(gone, "name", "left").select("name", "n", F.greatest(F.col("n") + F.col("support") + F.coalesce("change", F.lit(0.0)), F.lit(1e-3)).alias("prior"), stays.alias("stays")))
        made = {r["edit"]: r["m"] for r in moved.groupBy("edit").agg(F.sum("m").alias("m")).collect()}
        rates = [min(max(made.get(k, 0.0) / rows, 1e-4), 0.5) for k in range(len(EDITS))]
    # To where the spelling it is attached to is attached itself: the steps double, and each goes up in prior.
    at = stored(best)
    while True:
        onward = at.select(F.col("name").alias("to"), F.col("to").alias("end"))
        further = at.join(onward, "to", "left")
        if further.where("end is not null").isEmpty():
            break
        at = stored(further.select("name", F.coalesce("end", "to").alias("to")))
    return stored(named.join(at, "name", "left").select("id", F.coalesce("to", "name").alias("person"))), sum(rates)


def _support(names: DataFrame) -> DataFrame:
    """``name, support``: rows of names of other shapes with the same first name and father, or origin, in equal parts to all names of a shape that agree."""
    keys = [F.struct(F.lit(c).alias("of"), F.concat_ws("|", "given", c).alias("key"), F.length(c).alias("held")) for c in ("father", "origin")]
    each = names.select("name", "kind", "n", F.explode(F.array(*keys)).alias("k")).where("k.held > 0").select("name", "kind", "n", "k.of", "k.key")
    shapes = each.groupBy("of", "key", "kind").agg(F.sum("n").alias("mass"), F.count("*").alias("bearers"))
    whole = shapes.groupBy("of", "key").agg(F.sum("mass").alias("all"))
    share = shapes.join(whole, ["of", "key"]).select("of", "key", "kind", ((F.col("all") - F.col("mass")) / F.col("bearers")).alias("share")).where("share > 0")
    return each.join(share, ["of", "key", "kind"]).groupBy("name").agg(F.sum("share").alias("support"))


def same_person_pairs(df: DataFrame, column: str, channel: Channel = Channel()) -> DataFrame:
    """Pairs ``a < b`` (code point order) of distinct values of ``column`` that name one person.

    Null and blank values and first names alone are in no pair; a byname, kunya, father or origin alone is in pairs
    if it is one person's. A spelling is as
    frequent as distinct values write it, since copies of a value were typed once; an empty table gives no pairs.
    """
    named = persons(parsed(df, column), channel).select(F.col("value").alias("id"), "person")
    several = named.groupBy("person").count().where("count > 1").select(F.col("person").alias("person_a"), F.col("person").alias("person_b"))
    return expand_pairs(several, named.hint("merge"), ["person"])


def same_person_groups(df: DataFrame, column: str, channel: Channel = Channel()) -> DataFrame:
    """``value, person, values``: every distinct value that names one person, the person's canonical name in parts, and how
    many values name that person. The membership behind :func:`same_person_pairs`, one row a value."""
    named = persons(parsed(df, column), channel)
    return named.hint("merge").join(named.groupBy("person").agg(F.count("*").alias("values")), "person").select("value", "person", "values")


@dataclass(frozen=True)
class Linkage:
    """Parameters: rounds of expectation-maximisation, pseudo-counts, weight of the levels expected of
    unrelated people as a share of what is seen, least posterior of a link, and least log odds of a candidate."""

    rounds: int = 100
    smoothing: float = 0.5
    strength: float = 1.0
    posterior: float = 0.5
    least: float = -3.0


def _biographies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = []
        for name, death in zip(batch.column("name").to_pylist(), batch.column("death").to_pylist(), strict=True):
            latin = ARABIC.split(name or "")[0]
            names.append(parse(latin)._replace(year=year_of(death)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), *_columns(names)], names=["id", *PARTS])


def estimate(patterns: list[tuple[tuple[int, ...], int]], chance: list[tuple[float, float]], p: Linkage) -> dict[tuple[int, ...], float]:
    """Log odds of a match for each pattern of agreement levels.

    Match and non-match probabilities come from expectation-maximisation over the patterns' frequencies. As all
    candidates agree in two parts, non-matches are not independent in their parts: they are a
    mixture of people who agree in all but one part, one class for each part. In that part a class has its own
    probabilities of the levels, in the others those of matches. ``chance``: for each part, how often two
    records drawn at random have it equal, and have the same first letter; from these the non-match
    probabilities start, and towards these they are smoothed. Missing parts say nothing.
    """
    levels_ = np.array([x for x, _ in patterns])
    n = np.array([c for _, c in patterns], np.float64)
    fields = range(levels_.shape[1])
    m = np.tile([1.0, 0.002, 0.1, 0.1, 0.8], (len(fields), 1))
    start = np.array([[1.0, 1 - 5 * e - i, i, 4 * e, e] for e, i in chance])
    u = start.copy()
    share = np.array([0.7, *[0.3 / len(fields)] * len(fields)])
    seen = lambda f, weight: np.bincount(levels_[:, f], weight, 5)[1:]
    for last in range(p.rounds + 1):
        alike = np.array([np.log(m[f, levels_[:, f]]) for f in fields])
        apart = np.array([np.log(u[f, levels_[:, f]]) for f in fields]) - alike
        odds = np.log(share[0]) - np.logaddexp.reduce(np.log(share[1:])[:, None] + apart, axis=0)
        if last == p.rounds:
            return {x: float(o) for (x, _), o in zip(patterns, odds, strict=True)}
        each = np.concatenate([np.zeros((1, len(n))), apart]) + np.log(share)[:, None]
        each = np.exp(each - np.logaddexp.reduce(each, axis=0))
        for f in fields:
            counts = seen(f, n * (1 - each[1 + f])) + p.smoothing * np.array([0.02, 1, 1, 1])
            m[f, 1:] = counts / counts.sum()
            counts = seen(f, n * each[1 + f])
            counts = counts + start[f, 1:] * (p.strength * counts.sum() + 1)
            u[f, 1:] = counts / counts.sum()
        share = np.maximum((n * each).sum(axis=1) / n.sum(), 1e-6)


def _chances(left: DataFrame, right: DataFrame) -> list[tuple[float, float]]:
    """For each part, how often it is equal, and has the same first letter, in random pairs."""

    def share(side, of):
        cells = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), of(F.col(c).cast("string")).alias("v")) for i, c in enumerate(PARTS)])).alias("e")
        held = side.select(cells).where("e.v <> ''").groupBy("e.f", "e.v").agg(F.count("*").alias("n"))
        return held.join(held.groupBy("f").agg(F.sum("n").alias("all")), "f").select("f", "v", (F.col("n") / F.col("all")).alias("q"))

    out = []
    for of in (lambda c: F.when(F.length(c) > 1, c), lambda c: F.substring(c, 1, 1)):
        both = share(left, of).join(share(right, of).withColumnRenamed("q", "r"), ["f", "v"]).groupBy("f").agg(F.sum(F.col("q") * F.col("r")).alias("s"))
        found = {r["f"]: r["s"] for r in both.collect()}
        out.append([min(max(found.get(i, 0.001), 1e-5), 0.09) for i in range(len(PARTS))])
    return list(zip(*out, strict=True))


def linked(df: DataFrame, column: str, bios: DataFrame, bio_id: str, bio_name: str, bio_death: str, p: Linkage = Linkage()) -> DataFrame:
    """``value, bio_id, confidence``: biographies of the person each distinct value of ``column`` names.

    Candidates share two whole parts of the name but for one edit, in any of ten blocking
    passes. Levels of agreement of six parts (kunya, first name, father, origin, byname,
    year of death) give the odds of a match, with match and non-match probabilities from
    expectation-maximisation (:func:`estimate`). A value names one person, so candidates that
    contradict one another in a part exclude each other: the confidence is the posterior of a candidate
    against no match and against the most probable candidate that contradicts it. Several biographies of
    a person do not, and all are linked; a value that fits two people equally well has no posterior
    above one half, and no link. Null and blank names, unusable years and parts that
    are missing say nothing; ``bio_id`` must be unique, repeated values count once.
    """
    values = parsed(df, column)
    with by_true_size(df.sparkSession):
        rows = forms(values)
        people = bios.select(F.col(bio_id).cast("string").alias("id"), F.col(bio_name).alias("name"), F.col(bio_death).cast("string").alias("death")).where("id is not null")
        people = stored(people.mapInArrow(_biographies, f"id string, {_PART_TYPES}"))
        pairs = compared(rows, people)
        level_names = [f"l_{c}" for c in PARTS]
        counted = pairs.groupBy(*level_names).agg(F.count("*").alias("n")).collect()
        patterns = sorted((tuple(r[:6]), r["n"]) for r in counted)
        odds = estimate(patterns, _chances(rows, people), p) if patterns else {}
        # At most 5 to the power of 6 patterns.
        table = df.sparkSession.createDataFrame([(*map(int, x), o) for x, o in odds.items()], ", ".join(f"{c} tinyint" for c in level_names) + ", odds double")
        scored = pairs.join(F.broadcast(table), level_names).where(F.col("odds") >= p.least).join(people.withColumnRenamed("id", "id_b"), "id_b")
        # Parts that can contradict another: whole ones.
        parts = [*[F.when(F.length(c) > 1, F.col(c)).alias(c) for c in PARTS[:5]], F.col("year")]
        scored = stored(scored.select("id_a", "id_b", "odds", *parts))

    # The best value of each part, and the best odds of a candidate that contradicts it: two aggregations, no pairs of candidates.
    best = scored.groupBy("id_a").agg(*[F.max(F.when(F.col(c).isNotNull(), F.struct("odds", F.col(c).alias("v")))).alias(f"t_{c}") for c in PARTS])
    scored = scored.join(best.hint("merge"), "id_a")
    against = {c: F.coalesce(_contradict(c, F.col(c), F.col(f"t_{c}.v")), F.lit(False)) for c in PARTS}
    second = scored.groupBy("id_a").agg(*[F.max(F.when(against[c], F.col("odds"))).alias(f"s_{c}") for c in PARTS])
    rivals = [F.when(F.col(c).isNotNull(), F.when(against[c], F.col(f"t_{c}.odds")).otherwise(F.col(f"s_{c}"))) for c in PARTS]
    scored = scored.join(second.hint("merge"), "id_a").withColumn("rival", F.greatest(*rivals))
    confidence = 1 / (1 + F.exp(-F.col("odds")) + F.coalesce(F.exp(F.col("rival") - F.col("odds")), F.lit(0.0)))
    kept = scored.select(F.col("id_a").alias("id"), F.col("id_b").alias(bio_id), confidence.alias("confidence")).where(F.col("confidence") >= p.posterior)
    return values.withColumn("id", _form_id()).join(kept.hint("merge"), "id").select("value", bio_id, "confidence")


def _contradict(part: str, a, b):
    """Two names further apart than one edit, or years more than one apart; null if either is missing."""
    if part == "year":
        return F.abs(a - b) > 1
    letters = lambda c: F.array_sort(F.split(c, ""))
    apart = F.levenshtein(a, b)
    return (apart > 1) & ~((apart == 2) & (letters(a) == letters(b)))
