"""Canonical word form of texts, computed batch-wise (Arrow) because Spark has no Unicode normalisation.

Two texts are the same apart from formatting when their letters, marks and digits agree in
order, ignoring case and canonically equivalent encodings. ``words_of`` gives the words
(runs of those characters, format characters removed) parted by single spaces; without the
spaces it is the comparison key.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

import numpy as np
import regex
import xxhash

_PART = "\x1e"
_FORMAT = regex.compile(r"\p{Cf}+")
_OTHER = regex.compile(r"[^\p{L}\p{M}\p{N}\x1e]+")
_TELUGU = regex.compile(r"[ఀ-౿]")


def words_of(texts: Iterable[str | None]) -> list[str]:
    """Canonical words of each text; null and unreadable texts give the empty string."""
    joined = _PART.join("" if t is None else t.replace(_PART, " ") for t in texts)
    if not joined.isascii():
        joined = _FORMAT.sub("", unicodedata.normalize("NFD", unicodedata.normalize("NFD", joined).casefold()))
    else:
        joined = joined.lower()
    joined = _OTHER.sub(" ", joined)
    return [x.strip(" ") for x in joined.split(_PART)]


def telugu_first(roman: list[str | None], telugu: list[str | None]) -> tuple[list[str | None], list[str | None]]:
    """(Telugu sides, Roman sides): the field with more Telugu characters is the Telugu side; a tie keeps the columns."""
    te, ro = list(telugu), list(roman)
    for i, r in enumerate(roman):
        if r and not r.isascii() and _TELUGU.search(r):
            t = telugu[i]
            if t is None or len(_TELUGU.findall(r)) > len(_TELUGU.findall(t)):
                te[i], ro[i] = r, t
    return te, ro


def key_pairs(texts: Iterable[str]) -> np.ndarray:
    """128-bit keys as two int64 columns."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in texts), dtype="<i8").reshape(-1, 2)
