"""Scalar functions on text, as column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sanadflow.functions.profiles import CORPUS, VERDICT, Profile


def _per_value(f):
    return lambda texts: texts.map({x: f(x) for x in texts.dropna().unique()}).astype(object).where(texts.notna(), None)


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return _per_value(lambda x: unicodedata.normalize("NFKC", x))(texts)


@F.pandas_udf(StringType())
def _no_combining(texts: pd.Series) -> pd.Series:
    return _per_value(lambda x: "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)))(texts)


def _beyond_ascii(f, col: Column) -> Column:
    """``f`` only where a character beyond ASCII could make it matter."""
    return F.coalesce(f(F.when(F.octet_length(col) > F.char_length(col), col)), col)


def compatibility(col: Column) -> Column:
    """NFKC; ASCII texts stay in the JVM."""
    return _beyond_ascii(_nfkc, col)


def strip_marks(col: Column) -> Column:
    """Decomposed, without combining characters."""
    return _beyond_ascii(_no_combining, col)


def collapse(col: Column) -> Column:
    """Runs of white space, of any kind, as one space; none at the ends."""
    return F.trim(F.regexp_replace(col, r"(?U)[\s\x1c-\x1f]+", " "))


def normalise(col: Column, profile: Profile = CORPUS) -> Column:
    """Marks dropped and letters folded; null gives ''. The ``verdict`` profile also composes
    compatibility forms, blanks all but Arabic letters and collapses spaces."""
    out = F.coalesce(col, F.lit(""))
    if profile.compatibility:
        out = compatibility(out)
    if profile.lower:
        out = F.lower(out)
    if profile.marks:
        out = F.regexp_replace(out, f"[{profile.marks}]", "")
    if profile.folds:
        out = F.translate(out, *profile.pairs)
    return collapse(F.regexp_replace(out, f"[^{profile.words} ]", " ")) if profile.compatibility else out


def words(col: Column, profile: Profile = CORPUS) -> Column:
    """Content words in order: stop words and words under ``profile.shortest`` letters left out."""
    out = normalise(col, profile)
    if profile.blessing:
        out = F.regexp_replace(out, profile.blessing.replace(" ", r"\s+"), " ")
    keep = lambda w: F.length(w) >= profile.shortest
    found = F.filter(F.split(out, f"[^{profile.words}]+"), keep)
    return F.filter(found, lambda w: ~w.isin(*sorted(profile.stop))) if profile.stop else found


def word_set(col: Column, profile: Profile = CORPUS) -> Column:
    """Distinct content words, sorted."""
    return F.array_sort(F.array_distinct(words(col, profile)))


def is_attributed(col: Column, profile: Profile = CORPUS, whole_cues: bool = False) -> Column:
    """Holds one of the markers and one of the cues; cues are looked for inside words too, unless ``whole_cues``."""
    text = normalise(col, profile)
    cues = "|".join(profile.cues)
    return text.rlike("|".join(profile.markers)) & text.rlike(f"(^|[^{profile.words}])({cues})($|[^{profile.words}])" if whole_cues else cues)


def is_attributed_by(narrator: Column, text: Column, profile: Profile = CORPUS, whole_cues: bool = False) -> Column:
    """:func:`is_attributed` of the narrator's field and the text together, as some collections keep the chain in the former."""
    return is_attributed(F.concat_ws(" ", narrator, text), profile, whole_cues)


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(F.size(a) + F.size(b) > 0, both / (F.size(a) + F.size(b) - both))


def coverage(a: Column, b: Column) -> Column:
    return F.when(F.least(F.size(a), F.size(b)) > 0, F.size(F.array_intersect(a, b)).cast("double") / F.least(F.size(a), F.size(b)))


def match_score(a: Column, b: Column) -> Column:
    """The greater of Jaccard similarity and nine tenths of coverage."""
    return F.coalesce(F.greatest(jaccard(a, b), coverage(a, b) * 0.9), F.lit(0.0))


def score_text(col: Column) -> Column:
    """Two decimals, ties to even."""
    return F.call_function("format_number", col, F.lit("0.00"))


def spaced_words(col: Column) -> Column:
    """What stands between white space, in order; null and blank give one ''."""
    return F.split(collapse(F.coalesce(col, F.lit(""))), " ")


def query_phrase(col: Column, size: int = 7) -> Column:
    """``size`` words from a third of the text on; the first ones where fewer are left."""
    each = spaced_words(col)
    start = F.floor(F.size(each) / 3).cast("int") + 1
    late = F.slice(each, start, size)
    return F.array_join(F.when(F.size(late) == size, late).otherwise(F.slice(each, 1, size)), " ")


# Verdict words in the order in which they decide, and the class of each.
VERDICTS = (
    (("موضوع", "مكذوب"), "Mawdu' (fabricated)"),
    (("باطل",), "Batil (false)"),
    (("لا اصل له",), "No basis"),
    (("ضعيف", "منكر", "شاذ"), "Da'if (weak)"),
    (("حسن.*صحيح|صحيح.*حسن",), "Hasan Sahih"),
    (("حسن",), "Hasan (good)"),
    (("صحيح", "ثابت"), "Sahih (authentic)"),
    (("جيد",), "Jayyid (good chain)"),
)


def verdict_class(col: Column) -> Column:
    """Class of an Arabic verdict; 'Ungraded' if it says nothing, 'Other: ' and its first 40 characters if unknown."""
    text = normalise(col, VERDICT)
    out = F.when(text == "", "Ungraded")
    for found, name in VERDICTS:
        out = out.when(text.rlike("|".join(found)), name)
    return out.otherwise(F.concat(F.lit("Other: "), F.substring(col, 1, 40)))


def verdict_negated(col: Column) -> Column:
    """The verdict holds a negation, which :func:`verdict_class` does not look at."""
    return normalise(col, VERDICT).rlike("(^| )(ليس|لا|غير|لم)( |$)")


def tolerant_int(col: Column, low: int = 0, high: int = 1400) -> Column:
    """An integer typed as any number; null for what is none or lies outside the bounds."""
    number = F.trim(col).try_cast("double").try_cast("int")
    return F.when(number.between(low, high), number)


def blank_markers(col: Column) -> Column:
    """'' for the usual markers of nothing, and for null."""
    text = F.trim(F.coalesce(col, F.lit("")))
    return F.when(text.isin("", "-", "NA", "nan", "NaN", "None"), "").otherwise(text)


def title_case(col: Column) -> Column:
    """First letter of every run of letters raised, the others lowered."""
    return F.array_join(F.transform(F.split(col, r"(?<!\p{L})(?=\p{L})"), F.initcap), "")


def excerpt(text: Column, start: Column, end: Column) -> Column:
    """``text, error``: from ``start`` to ``end``, both included and either may be null or '', with '…' where
    something is cut. A marker that does not occur gives a null text and the error 'start' or 'end'."""
    text = collapse(text)
    starts, ends = F.coalesce(start, F.lit("")), F.coalesce(end, F.lit(""))
    i = F.when(starts == "", 1).otherwise(F.instr(text, starts))
    j = F.when(ends == "", F.length(text) + 1).otherwise(F.call_function("locate", ends, text, F.greatest(i, F.lit(1))))
    stop = F.when(ends == "", F.length(text) + 1).otherwise(j + F.length(ends))
    whole = F.concat(F.when(i > 1, "…").otherwise(""), F.substring(text, i, stop - i), F.when(stop <= F.length(text), "…").otherwise(""))
    error = F.when(i == 0, "start").when(j == 0, "end")
    return F.struct(F.when(error.isNull(), whole).alias("text"), error.alias("error"))


def basename(path: Column) -> Column:
    """What follows the last slash."""
    return F.regexp_extract(path, r"([^/]*)$", 1)


def swap_suffix(path: Column, old: str, new: str) -> Column:
    """``path`` with the ending ``old`` replaced by ``new``; unchanged if it does not end so."""
    return F.when(path.endswith(old), F.concat(F.substring(path, F.lit(1), F.length(path) - len(old)), F.lit(new))).otherwise(path)
