"""One form for text that looks the same (problem 6).

``look_form`` keeps every difference a reader sees; ``canonical_form`` folds case as
well. Only texts holding a character that could change leave the JVM; they are
worked on in Arrow batches, once for each distinct value of a batch.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sanadflow.operators.pairs import expand_pairs
from sanadflow.plans.layout import cut, spread

# Letters of other alphabets or languages with the shape of another letter,
# as (letters, letters they look like), by alphabet. Cyrillic, Greek, Armenian to Latin;
# letters and digits of Persian and Urdu to Arabic.
SAME_SHAPE = (
    ("АВЕЅІЈКМНОРСТХԜԚӀ", "ABESIJKMHOPCTXWQI"),
    ("аеѕіјорсухһԁԛԝ", "aesijopcyxhdqw"),
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "ABEZHIKMNOPTYXCJ"),
    ("ονϲϳ", "ovcj"),
    ("օոսց", "onug"),
    ("کیہ", "كيه"),
    ("۰۱۲۳۷۸۹", "٠١٢٣٧٨٩"),
)
# Ranges of default-ignorable code points (Unicode property of that name).
IGNORABLE = (
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E),
    (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
)
#: Compatibility mappings that leave the look unchanged: width, presentation forms, kinds of space, ligatures.
SAME_LOOK = {"<wide>", "<narrow>", "<initial>", "<medial>", "<final>", "<isolated>", "<noBreak>", "<compat>"}
_SHAPE = {ord(a): b for one, other in SAME_SHAPE for a, b in zip(one, other, strict=True)}


def _ignorable(o: int) -> bool:
    return any(a <= o <= b for a, b in IGNORABLE)


class _Look(dict):
    """``str.translate`` table filled as characters are met."""

    def __missing__(self, o: int) -> str:
        c = chr(o)
        if _ignorable(o):
            to = ""
        elif unicodedata.category(c) == "Zs":
            to = " "
        else:
            parts = unicodedata.decomposition(c).split(" ")
            to = c
            if parts[0] in SAME_LOOK:
                plain = "".join(chr(int(x, 16)) for x in parts[1:])
                # A ligature or positional form stands for letters; a compat mapping of signs or digits changes the look.
                if parts[0] != "<compat>" or all(x.isalpha() for x in plain) and len(plain) > 1:
                    to = plain.translate(self)
        to = "".join(_SHAPE.get(ord(x), x) for x in to)
        self[o] = to
        return to


_LOOK = _Look()

def look(text: str) -> str:
    """The form shared by all texts that look the same: composed, widths, ligatures and
    positional forms resolved, nothing invisible, one kind of space, look-alike letters
    written as one. Case, marks, signs, line breaks and the number of spaces stay."""
    if text.isascii():
        return text
    text = unicodedata.normalize("NFC", text).translate(_LOOK)
    if unicodedata.is_normalized("NFC", text):
        return text
    return unicodedata.normalize("NFC", text).translate(_SHAPE)


def canonical(text: str) -> str:
    """Compatibility-composed (NFKC), fully case-folded, white space mapped to single
    spaces, default-ignorable characters removed, look-alike letters written as one."""
    return _folded(look(text))


def _folded(text: str) -> str:
    if text.isascii():
        return " ".join(text.lower().split())
    text = unicodedata.normalize("NFKC", text).casefold()
    return " ".join(unicodedata.normalize("NFKC", text.translate(_SHAPE)).split())


def _per_distinct(f, texts: pd.Series) -> pd.Series:
    return texts.map({x: f(x) for x in texts.unique() if x is not None}).astype(object).where(texts.notna(), None)


@F.pandas_udf(StringType())
def _look_udf(texts: pd.Series) -> pd.Series:
    return _per_distinct(look, texts)


@F.pandas_udf(StringType())
def _canonical_udf(texts: pd.Series) -> pd.Series:
    return _per_distinct(canonical, texts)


def _beyond_ascii(col: Column) -> Column:
    return F.when(F.octet_length(col) > F.char_length(col), col)


def look_form(col: Column) -> Column:
    """Column form of :func:`look`; null stays null. ASCII texts never leave the JVM."""
    return F.coalesce(_look_udf(_beyond_ascii(col)), col)


def canonical_form(col: Column) -> Column:
    """Column form of :func:`canonical`; null stays null, blank text gives ''."""
    return F.coalesce(_canonical_udf(_beyond_ascii(col)), F.trim(F.regexp_replace(F.lower(col), "[\\s\\x1c-\\x1f]+", " ")))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of canonical form, look and stored form, made once for each distinct text of a batch."""
    signed = lambda values: np.array(values, np.uint64).view(np.int64)
    for batch in batches:
        texts = batch.column("text").dictionary_encode()
        distinct, at = texts.dictionary.to_pylist(), np.asarray(texts.indices, np.int64)
        looks = [look(x) for x in distinct]
        columns = ([xxhash.xxh3_64_intdigest(_folded(x)) for x in looks], [xxhash.xxh3_64_intdigest(x) for x in looks], [xxhash.xxh3_64_intdigest(x) for x in distinct])
        yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(signed(x)[at]) for x in columns)], names=["id", "k1", "k2", "f"])


def with_forms(df: DataFrame, text: str, look_as: str = "look", canonical_as: str = "canonical") -> DataFrame:
    """``df`` with both forms of ``text`` added; existing columns of these names are replaced.

    Null text gives null forms, empty text empty ones; rows are neither dropped nor merged.
    """
    return df.withColumns({look_as: look_form(F.col(text)), canonical_as: canonical_form(F.col(text))})


def same_look_pairs(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Pairs ``id_a < id_b`` of rows whose texts look the same but are stored differently.

    Rows are grouped by canonical form; as that also folds case and runs of spaces, which
    a reader sees, the look must be equal too. Only ids and hashes of the forms are shuffled. Groups are taken apart by stored
    form first: the pairs of forms of one look are found among distinct forms, and only
    those are expanded to rows, so many equal copies are never compared with each other.
    Null texts are in no pair; equal stored texts are no pair; ids must be unique.
    """
    kind = df.schema[id_col].dataType.simpleString()
    texts = spread(df.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))).where("text is not null")
    # The hashes are written once, as keys, members and forms all read them.
    rows = cut(texts.mapInArrow(_hashed, f"id {kind}, k1 long, k2 long, f long"))
    several = rows.groupBy("k1", "k2").agg(F.min("f").alias("lo"), F.max("f").alias("hi")).where("lo < hi").select("k1", "k2")
    members = rows.join(several, ["k1", "k2"], "left_semi")
    forms = members.select("k1", "k2", "f").distinct()
    a, b = (forms.select("k1", "k2", F.col("f").alias(f"f_{x}")) for x in "ab")
    links = a.join(b, ["k1", "k2"]).where("f_a < f_b").select(F.col("k1").alias("k1_a"), F.col("k2").alias("k2_a"), "f_a", F.col("k1").alias("k1_b"), F.col("k2").alias("k2_b"), "f_b")
    return expand_pairs(links, members, ["k1", "k2", "f"]).select(F.col("a").alias("id_a"), F.col("b").alias("id_b"))


def look_groups(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``id, look_id, form_id, forms``: for every row with a text, its look, its stored form, and the number of
    stored forms that have this look. Rows of one ``look_id`` look the same; those of one ``form_id`` are stored alike.

    The membership behind :func:`same_look_pairs`, one row a row; ids of looks and forms are hex strings of hashes.
    """
    kind = df.schema[id_col].dataType.simpleString()
    texts = spread(df.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))).where("text is not null")
    rows = cut(texts.mapInArrow(_hashed, f"id {kind}, k1 long, k2 long, f long"))
    # Stored forms are counted first, so that many copies of one never meet in a task.
    forms = rows.select("k1", "k2", "f").distinct().groupBy("k1", "k2").agg(F.count("*").alias("forms"))
    return rows.join(forms, ["k1", "k2"]).select("id", F.concat(F.hex("k1"), F.lit("-"), F.hex("k2")).alias("look_id"), F.hex("f").alias("form_id"), "forms")
