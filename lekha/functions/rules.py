"""Spelling variants of romanised words: rule tables, whole words as Column expressions, and all rules in one Arrow pass."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lekha.functions.text import words

# Fixed values: (pattern, replacements) of each tier, in the order in which they are tried.
# Groups are written as in the replacement text \1; only the first match of a pattern is replaced.
TIER1 = [
    (r"aa", ["a"]),
    (r"ee", ["e", "i"]),
    (r"oo", ["o", "u"]),
    (r"uu", ["u"]),
    (r"(?<![a-z])kh", ["k"]),
    (r"(?<![a-z])gh", ["g"]),
    (r"bh", ["b"]),
    (r"ph", ["p", "f"]),
    (r"(?<=[aeiou])th", ["t"]),
    (r"(?<=[aeiou])dh", ["d"]),
    (r"kk", ["k"]),
    (r"tt", ["t"]),
    (r"dd", ["d"]),
    (r"pp", ["p"]),
    (r"mm", ["m"]),
    (r"nn", ["n"]),
    (r"ll", ["l"]),
    (r"ss", ["s"]),
    (r"cc", ["c"]),
    (r"rr", ["r"]),
    (r"\bv", ["w"]),
    (r"\bw", ["v"]),
    (r"([bcdfghjklmnpqrstvwxyz])u\b", [r"\1"]),
]
TIER2 = [
    (r"\bai\b", ["ay", "aay", "ae"]),
    (r"ai\b", ["ay", "aay"]),
    (r"au\b", ["ow", "avu"]),
    (r"\bau", ["ow", "av"]),
    (r"sh", ["s"]),
    (r"\bch", ["c"]),
    (r"\bT([aeiou])", [r"t\1"]),
    (r"\bD([aeiou])", [r"d\1"]),
    (r"ku\b", ["ki"]),
    (r"ki\b", ["ku", "ke"]),
    (r"ni\b", ["nu"]),
    (r"nu\b", ["ni", "n"]),
    (r"\blo\b", ["la"]),
    (r"\bla\b", ["lo"]),
    (r"to\b", ["thoo", "too", "tho"]),
    (r"gaa\b", ["ga"]),
    (r"laa\b", ["la"]),
    (r"raa\b", ["ra"]),
    (r"tunnaanu\b", ["tunna", "tuna"]),
    (r"tunnav\b", ["tunav", "tunaav"]),
    (r"tunnaav\b", ["tunnav", "tunav"]),
    (r"aanu\b", ["anu", "nu"]),
    (r"aaDu\b", ["adu", "aadu"]),
    (r"indi\b", ["undi"]),
    (r"undi\b", ["indi"]),
    (r"\bledu\b", ["le", "ledhu"]),
    (r"\bledhu\b", ["ledu", "le"]),
    (r"nu\b", ["n"]),
    (r"\bante\b", ["anthe", "antey", "anthey"]),
    (r"\banthe\b", ["ante", "antey", "anthey"]),
    (r"\bantey\b", ["ante", "anthe", "anthey"]),
    (r"\banthey\b", ["ante", "anthe", "antey"]),
    (r"am([bmp])", [r"an\1"]),
    (r"an([bmp])", [r"am\1"]),
    (r"am\b", ["an", "um"]),
    (r"em\b", ["im", "an"]),
    (r"ra\b", ["r"]),
]
TIER3 = [
    (r"eru\b", ["iru"]),
    (r"elu\b", ["ilu"]),
    (r"enu\b", ["inu"]),
    (r"([^aeiou])o([^aeiou])", [r"\1u\2"]),
    (r"([aeiou])v([aeiou])", [r"\1w\2"]),
    (r"([aeiou])w([aeiou])", [r"\1v\2"]),
    (r"\bjz", ["z"]),
    (r"\bzj", ["j"]),
    (r"\bjar", ["zar"]),
    (r"\bzar", ["jar"]),
    (r"ksh", ["x", "ks"]),
    (r"\bx\b", ["ksh", "ks"]),
    (r"aa\b", ["aaa"]),
    (r"oo\b", ["ooo"]),
    (r"ee\b", ["eee"]),
    (r"([bcdfghjklmnpqrstvwxyz])\b", [r"\1u"]),
    (r"\bnuvvu\b", ["nv"]),
    (r"\bnenu\b", ["ne"]),
    (r"\bthanks\b", ["tq", "thanx", "thnx"]),
    (r"\bokay\b", ["ok", "okk"]),
    (r"\bok\b", ["okay", "okk"]),
    (r"\bpakka\b", ["pukka", "paka"]),
    (r"\bpukka\b", ["pakka", "paka"]),
    (r"\bbilkul\b", ["bilkool", "bilkull"]),
    (r"\bbilkool\b", ["bilkul"]),
    (r"\bzaroor\b", ["jaroor", "zarur"]),
    (r"\bjaroor\b", ["zaroor", "zarur"]),
    (r"\bmast\b", ["maast", "masth"]),
    (r"\bthoda\b", ["toda", "thoda"]),
    (r"\bekdum\b", ["ek dum", "ekdham"]),
]
# Substitutes of whole words. Look-up is by the lower-case word, so the key ikkaDa is never found.
WORD_SUBS = {
    "antey": ["anthey", "anthe", "ante"], "anthey": ["antey", "anthe", "ante"], "anthe": ["antey", "anthey", "ante"], "ante": ["antey", "anthey", "anthe"],
    "avunu": ["avunaa", "avuna", "ownu", "ow"], "avunaa": ["avunu", "avuna", "ownu"], "avuna": ["avunu", "avunaa", "ownu"], "ownu": ["avunu", "avunaa"], "ow": ["avunu", "avunaa"],
    "ikkada": ["ikkade", "ikkaDa"], "ikkade": ["ikkada", "ikkaDa"], "ikkaDa": ["ikkada", "ikkade"],
    "ekkada": ["ekkade", "akkada"], "ekkade": ["ekkada"], "akkada": ["akkade"], "akkade": ["akkada"],
    "sare": ["sari", "sarle", "sarlee"], "sari": ["sare", "sarle"], "sarle": ["sare", "sari"], "sarlee": ["sare", "sari", "sarle"],
    "ledu": ["le", "ledhu", "leeDu"], "ledhu": ["ledu", "le"], "le": ["ledu", "ledhu"],
    "undi": ["undhi", "wundi"], "undhi": ["undi"], "wundi": ["undi"],
    "naaku": ["naku"], "naku": ["naaku"], "nenu": ["neenu"], "neenu": ["nenu"],
    "nuvvu": ["nuvu", "nuvvuu"], "nuvu": ["nuvvu"],
    "kaadu": ["kadu", "kaadhu"], "kadu": ["kaadu"], "kaadhu": ["kaadu", "kadu"],
    "raa": ["ra"], "ra": ["raa"],
    "konchem": ["kunchem", "koncem", "kuncham"], "kunchem": ["konchem", "koncem"], "koncem": ["konchem", "kunchem"],
    "baagundi": ["bagundi", "baagumdi", "bagumdi"], "bagundi": ["baagundi", "baagumdi"], "baagumdi": ["baagundi", "bagundi"],
    "vacchaanu": ["vachaanu", "vachanu"], "vachaanu": ["vacchaanu", "vachanu"], "vachanu": ["vacchaanu", "vachaanu"],
    "chesaanu": ["chesanu", "chessanu"], "chesanu": ["chesaanu", "chessanu"],
    "teliyadu": ["telidu", "theliyadu", "thelidu"], "telidu": ["teliyadu", "thelidu"], "theliyadu": ["teliyadu", "telidu"],
    "artham": ["ardham"], "ardham": ["artham"], "kaluddam": ["kaludam", "kaluddaam"], "kaludam": ["kaluddam"],
    "cheppu": ["chepu"], "chepu": ["cheppu"], "choodu": ["chudu", "choosu"], "chudu": ["choodu"], "choosu": ["choodu", "chudu"],
    "maatladutaanu": ["matladatanu", "maatladutanu"], "matladatanu": ["maatladutaanu"],
    "velthunnanu": ["veltunna", "velthunna", "veltuna"], "veltunna": ["velthunnanu", "velthunna"], "velthunna": ["velthunnanu", "veltunna"],
    "pakka": ["pukka", "paka", "pakaa"], "pukka": ["pakka", "paka"],
    "thanks": ["thanx", "thnx", "tanks"], "thanx": ["thanks", "tanks"], "tanks": ["thanks", "thanx"],
    "okay": ["ok", "okey", "okk"], "ok": ["okay", "okey"], "okey": ["ok", "okay"],
}

#: Substitutes of a rule or word that are tried.
TRIED = 2


def word_candidates(c: Column) -> Column:
    """Variants with one word replaced, words parted by single spaces."""
    w = words(c)
    subs = F.create_map(*[x for k, v in WORD_SUBS.items() for x in (F.lit(k), F.array(*map(F.lit, v[:TRIED])))])
    none = F.array().cast("array<string>")
    at = lambda word, i: F.transform(F.coalesce(F.try_element_at(subs, F.lower(word)), none), lambda s: F.array_join(F.concat(F.slice(w, 1, i), F.array(s), F.slice(w, i + 2, F.size(w))), " "))
    return F.filter(F.flatten(F.transform(w, at)), lambda v: v != c)


def _by_rule(pattern: str, replacements: list[str]):
    """Function from a text to its spellings by one rule: the first match replaced, by each replacement that is tried."""
    found = re.compile(pattern)
    tried = replacements[:TRIED]

    def spellings(t: str) -> list[str]:
        return [found.sub(r, t, count=1) for r in tried] if found.search(t) else []

    return spellings


def _by_word(t: str) -> list[str]:
    """Spellings with one word replaced, words parted by single spaces."""
    w = t.split()
    return [" ".join([*w[:i], sub, *w[i + 1 :]]) for i, x in enumerate(w) for sub in WORD_SUBS.get(x.lower(), ())[:TRIED]]


_STAGES = [[_by_rule(*r) for r in TIER1], [_by_rule(*r) for r in TIER2], [_by_word], [_by_rule(*r) for r in TIER3]]


def variant_batch(texts: list[str | None], most: int) -> list[list[str]]:
    """The variants of each text (:func:`variants`), rule by rule over the texts that still have room."""
    out: list[dict[str, None]] = [{} for _ in texts]
    for stage in _STAGES:
        room = {i: most - len(got) for i, got in enumerate(out) if len(got) < most and texts[i]}
        for rule in stage:
            for i in list(room):
                t = texts[i]
                fresh = [v.strip() for v in rule(t) if v != t and not v.isspace() and v]
                room[i] -= len(fresh)
                out[i].update((v, None) for v in fresh if v != t)
                if room[i] <= 0:
                    del room[i]
    return [list(got)[:most] for got in out]


@lru_cache
def _variants_of(most: int):
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def made(text: pd.Series) -> pd.Series:
        return pd.Series(variant_batch([t if isinstance(t, str) else None for t in text], most))

    return made


def variants(c: Column, most: int = 5) -> Column:
    """Up to ``most`` distinct spellings of a text, in the order in which tier 1, tier 2, words and tier 3 make them; none for null.

    A tier is begun while there is room, and stops after the rule with which it has made as
    many candidates as there was room at its start. In Arrow batches: as Column expressions
    every rule of every tier would be tried on every text.
    """
    return _variants_of(most)(c)
