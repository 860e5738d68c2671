"""Narrator names: the bare name in a field, the key names are matched by, generations and death years."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sanadflow.functions.text import strip_marks

# Patterns around a name. An aside is dropped if it holds an honorific.
ASIDE = r"ﷺ|saw|pbuh|الله|allah|may "
HONORIFICS = (
    r"\(\s*ﷺ\s*\)", r"\(\s*saw\s*\)", r"\(\s*pbuh\s*\)", r"\(\s*رضى? الله عنه[ا|م]?\s*\)", r"\(\s*may allah[^)]*\)",
    r"\bmay allah be pleased with (?:him|her|them)\b", r"\bradi\s*allahu\s*anh[ua]?\b", r"\bummul?\s+mu.?mini?n\b", r"\bal-?ansar[iy]\b", r"\bra\b",
)
OPENINGS = (
    r"it (?:was|has been) (?:narrated|reported|related)\s+(?:on the authority of|from|that|by)?\s*",
    r"it is (?:narrated|reported|related)\s+(?:on the authority of|from|that|by)?\s*",
    r"(?:this )?(?:hadith|tradition) (?:has been|is) (?:narrated|reported|transmitted)\s+(?:on the authority of|from|by)?\s*",
    r"narrated\s+", r"reported\s+by\s+", r"on the authority of\s+", r"from\s+", r"that\s+",
)
ENDINGS = (
    r"\s+(?:reported|narrated|says|stated|related|transmitted|mentioned)\b.*$", r"\s+said\b.*$", r"\s+(?:that|who)\b.*$",
    r"\s*\bthe (?:wife|daughter|son|freed slave|mawla|client) of\b.*$",
)
PARTICLES = r"\b(abu|abi|ibn|bint|umm)\s+(?=sa['’`]?[iy]?[de]+|as[- ])"
EDGES = " :,.;'\"-–—()"
DEGENERATE = ("abu", "abi", "ibn", "bint", "al", "abd", "umm", "ab", "the", "a")
# Spellings of one name, in the order in which they are replaced.
SPELLINGS = (
    ("[`‘’ʻʼʾʿ'’]", ""), (r"\bbinti?\b", "bint"), (r"\bbn\b", "ibn"), (r"\bbin\b", "ibn"), (r"\bb\.\s*", "ibn "), (r"\babi\b", "abu"), (r"\babee\b", "abu"),
    (r"\babdul\s*", "abd al"), (r"\babdur\s*", "abd al"), (r"\babdir\s*", "abd al"), (r"\bubaidullah\b", "ubayd allah"), (r"\bubaydullah\b", "ubayd allah"),
    (r"\babdullah\b", "abd allah"), (r"\babdallah\b", "abd allah"), (r"hurai?rah?\b", "hurayra"), (r"hurayrah\b", "hurayra"), (r"\baishah?\b", "aisha"),
    (r"\bayesha\b", "aisha"), (r"\bumar\b", "umar"), (r"\bomar\b", "umar"), (r"\buthmaan\b", "uthman"), (r"\baffaan\b", "affan"), (r"\bkhattaab\b", "khattab"),
    (r"\bmaalik\b", "malik"), (r"\bjaabir\b", "jabir"), (r"\banas\b", "anas"), (r"\bsaeed\b", "said"), (r"\bsaad\b", "sad"), (r"\bsa d\b", "sad"),
    (r"\bmuhammed\b", "muhammad"), (r"\bmohammad\b", "muhammad"), (r"\bal\s+", "al"), (r"\bal-", "al"), (r"\bel-", "al"), (r"\babu([a-z]{3,})\b", "abu $1"),
    (r"\bibn([a-z]{3,})\b", "ibn $1"), ("[^a-z ]", " "),
)
# Pattern of a generation, its label and rank, and the death years (AH) that fit it.
GENERATIONS = (
    (r"comp\.|companion", "Companion", 1, 11, 110), (r"taba'? tabi|succ\.", "Successor's successor", 3, 110, 240), (r"follower|tabi'", "Successor", 2, 60, 190),
    (r"3rd century", "3rd century AH", 4, 190, 310), (r"4th century", "4th century AH", 5, 280, 410), (r"rasool allah", "The Prophet", 0, 11, 320),
)
UNPLACED = ("Unplaced", 9, 11, 320)
GENERIC = ("abd allah", "abu", "ibn", "bint", "muhammad", "ali", "umar", "uthman", "anas", "jabir", "aisha", "abd alrahman", "said", "sad", "salim")

_ANY = "(?iu)"


def _without(col: Column, patterns, to: str = " ") -> Column:
    return reduce(lambda c, p: F.regexp_replace(c, _ANY + p, to), patterns, col)


def clean_name(col: Column) -> Column:
    """The bare name in a narrator field, lower case; '' if nothing in it identifies anyone. Null gives ''."""
    name = F.trim(F.coalesce(col, F.lit("")))
    name = F.regexp_replace(name, rf"{_ANY}\((?=[^)]*(?:{ASIDE}))[^)]*\)", "")
    name = F.trim(_without(F.lower(name), HONORIFICS))
    # Openings may be nested to any depth: one anchored repetition of them all.
    name = F.regexp_replace(name, f"{_ANY}^(?:(?:{'|'.join(OPENINGS)})\\s*)+", "")
    # "abu said" is a name, not somebody who said something.
    name = F.regexp_replace(F.trim(name), _ANY + PARTICLES, "$1" + chr(1))
    name = F.translate(_without(name, ENDINGS, ""), chr(1), " ")
    name = F.regexp_replace(name, f"^[{_class(EDGES)}]+|[{_class(EDGES)}]+$", "")
    parts = F.filter(F.split(name, r"[\s-]+"), lambda w: w != "")
    return F.when(F.size(F.filter(parts, lambda w: ~w.isin(*DEGENERATE))) == 0, "").otherwise(name)


def _class(characters: str) -> str:
    return "".join("\\" + c if c in "-()'\"[]^\\" else c for c in characters)


def match_key(col: Column) -> Column:
    """The name in one spelling, without marks: what names are compared by."""
    key = strip_marks(F.lower(F.coalesce(col, F.lit(""))))
    key = reduce(lambda c, s: F.regexp_replace(c, *s), SPELLINGS, key)
    return F.trim(F.regexp_replace(key, " +", " "))


def tokens(key: Column) -> Column:
    return F.filter(F.split(key, " "), lambda w: w != "")


def is_generic(key: Column) -> Column:
    """Too little to tell one person by: a common name, or fewer than two words besides particles."""
    telling = F.filter(tokens(key), lambda w: ~w.isin("ibn", "bint", "al", "abd"))
    return key.isin(*GENERIC) | (F.size(telling) < 2)


def generation(col: Column) -> Column:
    """``label, rank, low, high`` of a generation as typed; the years are those of a plausible death."""
    text = F.lower(F.coalesce(col, F.lit("")))
    row = lambda label, rank, low, high: F.struct(F.lit(label).alias("label"), F.lit(rank).alias("rank"), F.lit(low).alias("low"), F.lit(high).alias("high"))
    first, *rest = GENERATIONS
    out = F.when(text.rlike(first[0]), row(*first[1:]))
    for pattern, *what in rest:
        out = out.when(text.rlike(pattern), row(*what))
    return out.otherwise(row(*UNPLACED))


def latin_part(col: Column) -> Column:
    """What stands before the first Arabic letter of a biography's name."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(col, F.lit("")), r"(?s)[؀-ۿ].*$", ""), r"[\s(]+$", ""))


def arabic_part(col: Column) -> Column:
    """From the first Arabic letter on, up to a bracket; '' if there is none."""
    return F.trim(F.regexp_extract(F.coalesce(col, F.lit("")), r"([؀-ۿ][^(]*)", 1))
