"""Rule transliteration between Telugu and Roman schemes, in Arrow passes: a look-up for each character is several times slower as Column expressions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lekha.config import TELUGU

# Public ITRANS, Harvard-Kyoto and Velthuis spellings of the Telugu letters.
VOWELS = "అ ఆ ఇ ఈ ఉ ఊ ఋ ౠ ఎ ఏ ఐ ఒ ఓ ఔ".split()
SIGNS = [""] + "ా ి ీ ు ూ ృ ౄ ె ే ై ొ ో ౌ".split()
CONSONANTS = "క ఖ గ ఘ ఙ చ ఛ జ ఝ ఞ ట ఠ డ ఢ ణ త థ ద ధ న ప ఫ బ భ మ య ర ల వ శ ష స హ ళ ఱ".split()
ITRANS_VOWELS = "a A i I u U RRi RRI è e ai ò o au".split()
ITRANS_CONSONANTS = "k kh g gh ~N ch Ch j jh ~n T Th D Dh N t th d dh n p ph b bh m y r l v sh Sh s h L R".split()
VELTHUIS_VOWELS = "a aa i ii u uu .r .rr è e ai ò o au".split()
VELTHUIS_CONSONANTS = 'k kh g gh "n c ch j jh ~n .t .th .d .dh .n t th d dh n p ph b bh m y r l v "s .s s h .l r2'.split()
HK_VOWELS = "a A i I u U R RR è e ai ò o au".split()
HK_CONSONANTS = "k kh g gh G c ch j jh J T Th D Dh N t th d dh n p ph b bh m y r l v z S s h L r2".split()
ITRANS_OTHER = {"ం": "M", "ః": "H", "ఁ": ".N", "ఽ": ".a", "్": ""}
VELTHUIS_OTHER = {"ం": ".m", "ః": ".h", "ఁ": "/", "ఽ": ".a", "్": ""}
ITRANS_ALIASES = {"aa": "A", "ii": "I", "ee": "I", "uu": "U", "oo": "U", "c": "ch", "w": "v", "shh": "Sh", "x": "kSh", "f": "ph", ".m": "M", ".n": "M"}
DIGITS = dict(zip("౦౧౨౩౪౫౬౭౮౯", "0123456789"))
SIMPLER = (("A", "a"), ("I", "i"), ("U", "u"), ("è", "e"), ("ò", "o"), ("M", "m"), ("H", "h"), ("~", ""))

_BARE = "\ue000"  # marks the vowel that a consonant has by itself


def _table(vowels: list[str], consonants: list[str], other: dict[str, str]) -> dict[str, str]:
    return dict(zip(VOWELS, vowels)) | dict(zip(SIGNS[1:], vowels[1:])) | dict(zip(CONSONANTS, consonants)) | other | DIGITS | {_BARE: "a"}


_LONE = re.compile("([\u0c15-\u0c39])(?![\u0c3e-\u0c4d])")
_SIMPLE = str.maketrans(dict(SIMPLER))


def _spelled(t: str, table: dict[int, str]) -> str:
    """Each Telugu letter in its Roman spelling; consonants without a sign get their own vowel, other characters stay."""
    return _LONE.sub(rf"\1{_BARE}", t.replace("\u0c46\u0c56", "\u0c48")).translate(table)


def _plain(t: str, table: dict[int, str], normalise: bool) -> str:
    out = _spelled(t, table)
    if normalise and not out.isascii():
        out = unicodedata.normalize("NFC", out)
    return " ".join(out.translate(_SIMPLE).split()).lower()


_ITRANS, _VELTHUIS = (str.maketrans(_table(*x)) for x in ((ITRANS_VOWELS, ITRANS_CONSONANTS, ITRANS_OTHER), (VELTHUIS_VOWELS, VELTHUIS_CONSONANTS, VELTHUIS_OTHER)))


@F.pandas_udf(T.StringType())
def _romanized(text: pd.Series) -> pd.Series:
    return text.map(lambda t: _plain(t, _ITRANS, True), na_action="ignore")


@F.pandas_udf(T.StringType())
def _romanized_as_is(text: pd.Series) -> pd.Series:
    return text.map(lambda t: _plain(t, _ITRANS, False), na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _romanized_twice(text: pd.Series) -> pd.Series:
    both = lambda t: list(dict.fromkeys([_plain(t, _ITRANS, True), " ".join(_spelled(t, _VELTHUIS).lower().split())]))
    return text.map(both, na_action="ignore")


def romanize(c: Column, normalise: bool = True) -> Column:
    """Telugu to plain lower-case Roman: ITRANS without length and diacritics; other characters stay. Null stays null."""
    return _romanized(c) if normalise else _romanized_as_is(c)


def romanize_variants(c: Column) -> Column:
    """array: :func:`romanize` and, where different, lower-case Velthuis, which keeps vowel length."""
    return _romanized_twice(c)


def _scheme(vowels: list[str], consonants: list[str], other: dict[str, str], aliases: dict[str, str]) -> tuple[dict[str, str], ...]:
    free, sign = dict(zip(vowels, VOWELS)), dict(zip(vowels, SIGNS))
    cons = {k: v for k, v in zip(consonants, CONSONANTS) if k != "r2"}
    rest = {v: k for k, v in other.items() if v} | {v: k for k, v in DIGITS.items()}
    for a, b in aliases.items():
        for t in (free, sign, rest, cons):
            if b in t:
                t[a] = t[b]
    if aliases:
        cons["x"] = cons["kSh"] = "క్ష"
    return free, sign, cons, rest


SCHEMES = (
    _scheme(ITRANS_VOWELS, ITRANS_CONSONANTS, ITRANS_OTHER, ITRANS_ALIASES),
    _scheme(HK_VOWELS, HK_CONSONANTS, ITRANS_OTHER, {}),
    _scheme(VELTHUIS_VOWELS, VELTHUIS_CONSONANTS, VELTHUIS_OTHER, {}),
)


def _reader(scheme: tuple[dict[str, str], ...]):
    """Function from a Roman text to Telugu by one scheme: longest spellings first, vowels become signs after a consonant, consonants without vowel get a virama."""
    free, sign, cons, rest = scheme
    token = re.compile("|".join(re.escape(k) for k in sorted({*free, *cons, *rest}, key=lambda k: (-len(k), k))) + "|.", re.DOTALL)

    def read(t: str) -> str:
        out, tokens = [], token.findall(t)
        for before, x, after in zip(["", *tokens], tokens, [*tokens[1:], ""]):
            if x in cons:
                out.append(cons[x] if after in free else cons[x] + "్")
            else:
                vowel = sign.get(x) if before in cons else free.get(x)
                out.append(rest.get(x, x) if vowel is None else vowel)
        return " ".join("".join(out).split())

    return read


_READERS = tuple(map(_reader, SCHEMES))
_TELUGU_CHAR = re.compile(f"[{chr(TELUGU.low)}-{chr(TELUGU.high)}]")


def telugu_of(text: str | None) -> str:
    """Telugu of a Roman text by the scheme that gives the highest share of Telugu characters, the first of equals; a text without any stays as it is."""
    text = text or ""
    clean = " ".join((text if text.isascii() else unicodedata.normalize("NFC", text)).split())
    best, most = text, 0.0
    for read in _READERS:
        made = read(clean)
        if made and (share := len(_TELUGU_CHAR.findall(made)) / len(made)) > most:
            best, most = made, share
    return best


@F.pandas_udf(T.StringType())
def _telugu(text: pd.Series) -> pd.Series:
    return text.map(telugu_of)


def with_telugu(df: DataFrame, column: str, out: str) -> DataFrame:
    """Adds ``out``: Roman to Telugu by ITRANS, Harvard-Kyoto and Velthuis (:func:`telugu_of`), in one Arrow pass. Null counts as empty."""
    return df.withColumn(out, _telugu(F.col(column)))
