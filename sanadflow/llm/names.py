"""Parts of a personal name as people type it: byname of a child (kunya), first name, father, origin, byname, year.

Words after a particle (ibn, abu, al- and their spellings) are what the particle says. Names without particles
have the same parts: the first word is the first name, the last one the family's (``origin``), and what stands
between them the middle one (``father``); 'Family, First' is turned round.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import combinations
from typing import NamedTuple

from sanadflow.llm.textform import look


class Name(NamedTuple):
    """Parts in one spelling; '' where a part is missing. ``given`` and ``father`` may be one
    letter, an initial. ``year`` is a year of death."""

    kunya: str = ""
    given: str = ""
    father: str = ""
    origin: str = ""
    byname: str = ""
    year: int | None = None


# Words around a name, before and after it.
_BEFORE = re.compile(
    r"^(?:it (?:was|is|has been) (?:narrated|reported|related)(?: on the authority of| that| from| by)?|(?:this )?(?:narration|hadith|tradition)(?: is| was)?(?: reported| narrated)?(?: from| by)?"
    r"|on the authority of|narrated(?: by)?|reported(?: by)?|related(?: by)?|from|that)(?=\s|$)[\s:,]*",
    re.IGNORECASE,
)
_AFTER = re.compile(r"[\s,]+(?:said|says|reported|narrated|related|stated|mentioned)\s*$", re.IGNORECASE)
_YEAR = re.compile(r"[(\[]?\s*\b(?:died|d\.?)?\s*(?:in\s+)?(?:c\.?\s*)?(\d{1,4})\s*(?:a\.?h\.?|h\.?)?\s*[)\]]?(?=[\s,:;.)\]]|$)", re.IGNORECASE)
_BRACKET = re.compile(r"[(\[]([^()\[\]]*)[)\]]?")
_KNOWN = re.compile(r",?\s*\b(?:better\s+)?known as\s+", re.IGNORECASE)
_SON = re.compile(r"\b(?:son|daughter) of\b", re.IGNORECASE)
_SOUNDS = ((re.compile("sch"), "sh"), (re.compile("ou|oo|o"), "u"), (re.compile("ee|ei|e"), "i"), (re.compile("aa+"), "a"), (re.compile("uu+"), "u"), (re.compile("ii+"), "i"))
# Short forms of first names that are no beginnings of them, and the names.
NICKNAMES = (
    "bill william, will william, bob robert, rob robert, dick richard, rick richard, ted edward, ned edward, jack john, jim james, tom thomas, tony anthony, peggy margaret, "
    "meg margaret, betty elizabeth, liz elizabeth, beth elizabeth, kate katherine, sue susan, molly mary, polly mary, harry henry, hank henry, joe joseph, mike michael, dave david, pepe jose, paco francisco"
)
# Words that begin a description of somebody without a name.
NOBODY = {"a", "an", "the", "his", "her", "my", "our", "their", "one", "some", "someone", "somebody", "another", "people"}
_IBN = {"ibn", "bin", "bn", "b", "ben", "bint"}
_ABU = {"abu", "abi", "abou", "aboo", "abo", "umm"}
_AL = {"al", "el", "ul"}


def spelling(word: str) -> str:
    """One letter for each way of writing a vowel, sh for sch; no marks, no apostrophes."""
    word = "".join(c for c in unicodedata.normalize("NFKD", word) if unicodedata.category(c)[0] in "LN").lower()
    for pattern, to in _SOUNDS:
        word = pattern.sub(to, word)
    return word


def _tokens(text: str) -> list[str]:
    """Spellings with markers: 'ibn', 'abu', 'al' and ',' stand alone."""
    out = []
    for raw in re.findall(r"[^\s,;:()\[\]\"]+|[,;]", text):
        if raw in ",;":
            out.append(",")
            continue
        if m := re.match(r"(?:al|el)(?=[A-Z])", raw):
            out.append("al")
            raw = raw[m.end() :]
        for piece in filter(None, re.split(r"[-–.‐]+", raw)):
            word = spelling(piece)
            plain = re.sub(r"[^a-z]", "", piece.lower())
            if plain in _IBN and not (plain == "b" and (not out or out[-1] in (",", "ibn"))):
                out.append("ibn")
            elif plain in _ABU:
                out.append("abu")
            elif plain in _AL:
                out.append("al")
            elif word:
                out.append(word)
    return out


_MARK = {"ibn", "abu", "al", ","}
_FULL = {spelling(a): spelling(b) for a, b in (x.split() for x in NICKNAMES.split(", "))}


def _plain(text: str) -> Name:
    """A name without particles: first, middle and family name, the family's first if a comma follows it.
    Words without a capital beside others with one are no names."""
    words = text.split()
    if any(x[:1].isupper() for x in words):
        words = [x for x in words if not x[:1].islower()]
    elif words and words[0] in NOBODY:
        words = []
    parts = [x.split() for x in " ".join(_tokens(" ".join(words))).split(" , ")]
    parts = [x for x in ([t for t in p if t != ","] for p in parts) if x]
    if len(parts) > 1:
        parts = [[*parts[1], *(t for p in parts[2:] for t in p), *parts[0]]]
    if not parts:
        return Name()
    given, *rest = parts[0]
    return Name(given=_FULL.get(given, given), father=" ".join(rest[:-1]), origin=rest[-1] if rest else "")


def _unglue(tokens: list[str]) -> list[str]:
    """'ibnx' after a first name is 'ibn x' where the name has no other father."""
    if "ibn" in tokens:
        return tokens
    for i, t in enumerate(tokens):
        m = re.match(r"(?:ibn|bin|bn)(?=[a-z]{3})", t)
        if m and i > 0 and t not in _MARK:
            return [*tokens[:i], "ibn", t[m.end() :], *tokens[i + 1 :]]
    return tokens


def parse(value: str | None) -> Name:
    """The parts of ``value``; an empty :class:`Name` for null, blank and what names nobody."""
    if not value:
        return Name()
    text = " ".join(look(value).split())
    year = None
    for m in _YEAR.finditer(text):
        if 0 < int(m.group(1)) <= 1400:
            year = int(m.group(1))
    text = _YEAR.sub(" ", text)
    aside = [m.group(1) for m in _BRACKET.finditer(text)]
    text = _BRACKET.sub(" ", text).strip(" :,;.")
    before = None
    while before != text:
        before = text
        text = _AFTER.sub("", _BEFORE.sub("", " " + text if not text else text)).strip(" :,;")
    text = _SON.sub("ibn", text)
    text, *known = _KNOWN.split(text)
    byname = ""
    for extra in [*known, *aside]:
        t = [x for x in _tokens(extra) if x != ","]
        if len(t) == 2 and t[0] == "al":
            byname = t[1]
    kunya = given = father = origin = ""
    tokens = _unglue(_tokens(text))
    if not _MARK.intersection(tokens) - {","}:
        return _plain(text)._replace(byname=byname, year=year)
    for part in " ".join(tokens).split(" , "):
        t, i = part.split(), 0
        first = True
        while i < len(t):
            now, after = t[i], t[i + 1] if i + 1 < len(t) else ""
            if now == "abu" and after and after not in _MARK and not kunya:
                kunya, i = after, i + 2
            elif now == "ibn" and after and after not in _MARK:
                father, i = father or after, i + 2
            elif now == "al" and after and after not in _MARK:
                if first and i + 2 < len(t) and t[i + 2] == "ibn":
                    byname = byname or after
                else:
                    origin = origin or after
                i += 2
            elif now in _MARK:
                i += 1
            elif not given:
                given, i = now, i + 1
            else:
                # A further word: a middle name, or the family's if the father is known.
                father, origin, i = father or now, (origin or now) if father else origin, i + 1
            first = False
    return Name(kunya, given, father, origin, byname, year)


def near(a: str, b: str) -> int:
    """0 if equal, 1 if one letter is changed, left out, added or swapped with its neighbour, else 2."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < 3:
        return 2
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    x, y = a[i:], b[i:]
    if x[1:] == y[1:] or x[1:] == y or x == y[1:]:
        return 1
    return 1 if len(x) > 1 and len(y) > 1 and x[0] == y[1] and x[1] == y[0] and x[2:] == y[2:] else 2


def variants(word: str) -> list[str]:
    """The word and what is left when any one letter goes: words within one edit share one of these."""
    return sorted({word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}) if len(word) > 2 else [word]


def keys(n: Name) -> list[str]:
    """Blocking keys: any two whole parts together, one of them with at most one edit. Names that
    agree in two whole parts but for one edit share a key."""
    out = set()
    for (x, a), (y, b) in combinations(zip("kgfob", n[:5], strict=True), 2):
        tag = x + y
        if len(a) > 1 and len(b) > 1:
            out.update(f"{tag}:{v}|{b}" for v in variants(a))
            out.update(f"{tag}:{a}|{v}" for v in variants(b))
    return sorted(out)


def initial_keys(n: Name, asked: bool) -> list[str]:
    """Keys of a name of one whole part and an initial, such as 'J. Smith' (``asked``), and of whole names that it may stand for."""
    parts = dict(zip("kgfob", n[:5], strict=True))
    short = sum(len(x) > 1 for x in n[:5]) == 1
    out = set()
    for x in "gf":
        for y, b in parts.items():
            if y != x and parts[x] and len(b) > 1 and (len(parts[x]) == 1 and short if asked else len(parts[x]) > 1):
                out.add(f"i{x}{y}:{parts[x][0]}|{b}")
    return sorted(out)


MISSING, OTHER, INITIAL, NEAR, EQUAL = range(5)


def level(a: str, b: str) -> int:
    """How far two parts agree."""
    if not a or not b:
        return MISSING
    if len(a) == 1 or len(b) == 1:
        return INITIAL if a[0] == b[0] else OTHER
    return (EQUAL, NEAR, OTHER)[near(a, b)]


def year_level(a: int | None, b: int | None, within: int = 1) -> int:
    if a is None or b is None:
        return MISSING
    return EQUAL if a == b else NEAR if abs(a - b) <= within else OTHER


def levels(a: Name, b: Name) -> tuple[int, ...]:
    return (*(level(x, y) for x, y in zip(a[:5], b[:5], strict=True)), year_level(a.year, b.year))


_NUMBER = re.compile(r"\d+(?:\.\d+)?")


def year_of(value: str | None) -> int | None:
    """A Hijri year in any notation; null for markers of nothing and impossible years."""
    text = unicodedata.normalize("NFKC", str(value or ""))
    m = _NUMBER.search(text)
    year = int(float("".join(str(unicodedata.digit(c, c)) for c in m.group()))) if m else 0
    return year if 0 < year <= 1400 else None
