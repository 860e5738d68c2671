"""Words of a text in one form, in Arrow batches."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from sanadflow.llm.textform import look

# Forms of alef, hamza, yeh and teh marbuta, and the letters that stand for them; '' for what is left out.
ARABIC_FOLDS = (("آأإٱ", "ا"), ("ؤ", "و"), ("ئىی", "ي"), ("ةۃ", "ه"), ("ءـ", ""))
_WORD = re.compile(r"[^\W_]+")


class _Fold(dict):
    def __missing__(self, o: int):
        self[o] = out = None if unicodedata.category(chr(o))[0] == "M" or unicodedata.category(chr(o)) == "Cf" else o
        return out


_FOLD = _Fold({ord(x): to for group, to in ARABIC_FOLDS for x in group})


def words_of(text: str | None) -> list[str]:
    """Words in order, after look-alike characters, vowel marks, punctuation, case and the
    forms of alef, hamza, yeh and teh marbuta are made equal. Null and blank give none."""
    if not text:
        return []
    text = look(text).lower()
    return _WORD.findall(text if text.isascii() else text.translate(_FOLD))


def pieces(texts: pa.Array, characters: int = 2_000_000, rows: int = 512) -> list[tuple[int, int]]:
    """Start and length of runs of texts that are bounded in rows and, but for single longer texts, in characters."""
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    out, start, held = [], 0, 0
    for i, size in enumerate(sizes):
        if i > start and (held + size > characters or i - start >= rows):
            out.append((start, i - start))
            start, held = i, 0
        held += int(size)
    return [*out, (start, len(sizes) - start)] if len(sizes) else []


def word_arrays(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of ``texts`` in a row, and where those of each text end (with a leading 0)."""
    lists = [words_of(x) for x in texts.to_pylist()]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return pa.array([w for x in lists for w in x], pa.string()), ends


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of the words, computed once for each distinct one."""
    encoded = words.dictionary_encode()
    distinct = np.array(encoded.dictionary.to_pylist() or [""], dtype=object)
    return pd.util.hash_array(distinct, categorize=False).view(np.int64)[np.asarray(encoded.indices, np.int64)] if len(words) else np.zeros(0, np.int64)


def distinct_sorted(hashed: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets ``hashed[ends[i]:ends[i + 1]]`` sorted and without repeats, with their new ends."""
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    order = np.lexsort((hashed, owner))
    hashed, owner = hashed[order], owner[order]
    keep = np.ones(len(hashed), bool)
    keep[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
    return hashed[keep], np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=len(ends) - 1))]).astype(np.int64)
