"""Sentence boundaries across languages and scripts.

Three passes. The first learns, unsupervised and by log-likelihood ratios, abbreviations
(types that hardly occur without a point), abbreviations that may close a sentence (they
stand at line ends as often as other words), and collocations of a closing quotation with
the word after it (quotatives such as "said": the sentence goes on). The second counts what
follows points and sure sentence ends, and learns sentence starters and collocations of an
abbreviation or a number with the next word. The third classifies every end mark with these
statistics. Everything is learnt for each script over all documents and again for each
language (script and ``lang`` of the document); a document whose language is given is cut by
both lists, one without by those of its scripts alone.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lekha.session import materialize

#: End marks, quotation marks, brackets, and endings of addresses.
MARKS = ".!?।॥。！？؟۔።။។｡．"
QUOTES = {"“": "”", "‘": "’", "«": "»", "「": "」", "『": "』", '"': '"'}
BRACKETS = {"(": ")", "[": "]", "{": "}", "（": "）", "【": "】"}
ADDRESS_ENDS = "example|com|org|net|in|edu|gov|io|co|info|html|htm|php|pdf"

#: Thresholds of the learnt lists.
ABBREVIATION_SCORE, CLOSING_SHARE, LEAST_RATIO, LEAST_COUNT = 0.3, 0.25, 10.8, 5
#: A starter (Punkt's threshold) and how many times the other rate a starter's or collocation's rate is at least.
STARTER_RATIO, TIMES = 30.0, 3.0
#: Stands for all numbers, as a type and as a script.
NUMBER = "#"
#: A learnt list longer than this is refused rather than shipped to every task.
MODEL_LIMIT = 1_000_000

_OPEN = QUOTES | BRACKETS
_CLOSE = {c: o for o, c in _OPEN.items()}
_CLOSERS = set(_CLOSE) | {"'"}
_BREAK = r"(?>\r\n|[\n\r\v\f\x1c-\x1e\x85  ])"
_LINE = regex.compile(_BREAK)
_BLANK = regex.compile(rf"{_BREAK}(?:[^\S\n\r\v\f\x1c-\x1e\x85  ]*{_BREAK})+")
_EVENT = regex.compile(rf"[{regex.escape(MARKS)}…]+|[{regex.escape(''.join(set(_OPEN) | set(_CLOSE)))}]")
_INK = regex.compile(r"\S")
_NEXT = regex.compile(r"\s*(\S+)")
_CASE = regex.compile(r"(?<!\S)([\p{L}\p{M}]{2,})[.!?]\s+([\p{Lu}\p{Ll}])")
_FORMAT = regex.compile(r"\p{Cf}+")
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]")
_BULLET = regex.compile(r"(?:\d{1,3}[.)]|[•‣◦▪·*–—-])\s+")
_ADDRESS = regex.compile(rf"(?i)^(?:(?:https?://|ftp://|www\.)\S+|[\w.+-]+@[\w-]+(?:\.[\w-]+)+|[a-z0-9-]+(?:\.[a-z0-9-]+)*\.(?:{ADDRESS_ENDS})(?:[/?#]\S*)?)$")
_STRIP_L = "“‘«「『\"'([{（【•‣◦▪·*–—-,;:"
_STRIP_R = "”’»」』\"')]}）】,;:!?…।॥。！？؟"
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_CJK_START = regex.compile(r"[。！？｡．]\s?([\p{Han}\p{Hiragana}\p{Katakana}])")
_AFTER_QUOTE = regex.compile(r"(?<=[.!?।॥。！？])[”\"»」’』]\s{0,2}([^\s”\"»」’』“«‘「『(\[]+)")
_SCRIPTS = [("latin", regex.compile(r"\p{Latin}")), ("telugu", regex.compile(r"\p{Telugu}")), ("devanagari", regex.compile(r"\p{Devanagari}")), ("cjk", _CJK), ("kannada", regex.compile(r"\p{Kannada}")), ("tamil", regex.compile(r"\p{Tamil}")), ("malayalam", regex.compile(r"\p{Malayalam}")), ("arabic", regex.compile(r"\p{Arabic}")), ("cyrillic", regex.compile(r"\p{Cyrillic}"))]


def _script(word: str) -> str:
    return next((name for name, p in _SCRIPTS if p.search(word)), "other")


class Model(NamedTuple):
    """What is learnt: abbreviation types without their last point, those that may close a sentence, and words that carry a sentence on after a quotation; then those that never close one, types that start sentences, types that hardly do, and pairs (abbreviation or number, next type) inside a sentence."""

    abbreviations: frozenset[str]
    closing: frozenset[str]
    quotatives: frozenset[str]
    leading: frozenset[str] = frozenset()
    starters: frozenset[str] = frozenset()
    inner: frozenset[str] = frozenset()
    collocations: frozenset[tuple[str, str]] = frozenset()


def _merged(*models: Model) -> Model:
    return Model(*(frozenset().union(*sets) for sets in zip(*models)))


class Models(NamedTuple):
    """What is learnt over all documents, and what is learnt beside it for each language."""

    pooled: Model
    languages: dict[str, Model]

    def of(self, language: str) -> Model:
        own = self.languages.get(language)
        return self.pooled if own is None else _merged(self.pooled, own)


def _key(script: str, language: str) -> str:
    return f"{script}|{language}" if language else script


def _language(key: str) -> str:
    return key.partition("|")[2]


def _word_type(token: str) -> tuple[str, bool] | None:
    """(type, whether a single point follows it); None for tokens that say nothing about abbreviations."""
    t = token.lstrip(_STRIP_L).rstrip(_STRIP_R)
    dotted = t.endswith(".") and not t.endswith("..")
    t = _FORMAT.sub("", t.rstrip(".")).casefold()
    if not t or not _WORD.search(t) or t[-1].isdigit():
        return None
    return t, dotted


def _next_type(token: str) -> str | None:
    """Type of a word after a point; all numbers are one type."""
    if (k := _word_type(token)) is not None:
        return k[0]
    return NUMBER if token.lstrip(_STRIP_L)[:1].isdigit() else None


def _with_languages(parts: DataFrame, *values: str) -> DataFrame:
    """Sums of (script, lang, ...) by script and, for given languages, by script and language, both in ``script``."""
    keys = [c for c in parts.columns if c not in (*values, "lang")]
    once = materialize(parts.groupBy(*keys, "lang").agg(*[F.sum(v).alias(v) for v in values]), "p9sums")
    pooled = once.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])
    return pooled.unionByName(once.where("lang != ''").withColumn("script", F.concat_ws("|", "script", "lang")).drop("lang"))


def _texts(docs: DataFrame, text: str, line_bound: str, language: str) -> DataFrame:
    """(text, whether line breaks end sentences, language or the empty string)."""
    lang = F.coalesce(F.lower(F.trim(F.col(language))), F.lit("")) if language in docs.columns else F.lit("")
    return docs.select(F.col(text).alias("_t"), F.expr(line_bound).alias("_b"), lang.alias("_l"))


def _counts(docs: DataFrame, text: str, line_bound: str, language: str = "lang") -> DataFrame:
    """(kind, script, type, c1, c2) summed over all documents: 'w' with and without point, 'e' at line ends, 'q' after a quotation, 'c' characters of scripts without spaces."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[str, tuple[Counter[str], ...]] = {}
            for t, bound, lang in zip(*(c.to_pylist() for c in b.columns)):
                if not t:
                    continue
                tokens, ends, after, chars = seen.setdefault(lang, (Counter(), Counter(), Counter(), Counter()))
                tokens.update(t.split())
                if bound:
                    ends.update(last[-1] for line in t.splitlines() if (last := line.rsplit(None, 1)) and last[-1][-1] == ".")
                after.update(_AFTER_QUOTE.findall(t))
                if _CJK.search(t):
                    chars.update(_CJK.findall(t))
            out: Counter[tuple[str, str, str, str, bool]] = Counter()
            for lang, (tokens, ends, after, chars) in seen.items():
                for w, n in tokens.items():
                    if (k := _word_type(w)) is not None:
                        out["w", _script(k[0]), lang, k[0], k[1]] += n
                for w, n in ends.items():
                    if (k := _word_type(w)) is not None and k[1]:
                        out["e", _script(k[0]), lang, k[0], True] += n
                for w, n in after.items():
                    if _CJK.match(w):
                        out["q", "cjk", lang, w[0], True] += n
                    elif (k := _word_type(w)) is not None:
                        out["q", _script(k[0]), lang, k[0], True] += n
                for w, n in chars.items():
                    out["c", "cjk", lang, w, True] += n
            keys = list(out)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([k[i] for k in keys], pa.string()) for i in range(4)), pa.array([out[k] if k[4] else 0 for k in keys], pa.int64()), pa.array([0 if k[4] else out[k] for k in keys], pa.int64())],
                names=["kind", "script", "lang", "type", "c1", "c2"],
            )

    return _with_languages(_texts(docs, text, line_bound, language).mapInArrow(count, "kind string, script string, lang string, type string, c1 bigint, c2 bigint"), "c1", "c2")


def _follows(docs: DataFrame, text: str, line_bound: str, language: str, abbreviations: dict[str, frozenset[str]]) -> DataFrame:
    """(kind, script, left, right, n): 's' types after a sure sentence end, 'm' capitals and numbers amid a sentence, 'p' types after the point of an abbreviation or number, 'c' characters after an end mark in scripts without spaces. The script is that of ``right``; ``abbreviations`` are those of each language, the empty string for all."""
    ends = frozenset(MARKS + "…" + "".join(_CLOSERS))
    none = frozenset()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = abbreviations.get("", none)
        for b in batches:
            out: Counter[tuple[str, str, str, str]] = Counter()
            seen: dict[str, tuple[Counter[str], Counter[str]]] = {}
            for t, bound, lang in zip(*(c.to_pylist() for c in b.columns)):
                starts, mid = seen.setdefault(lang, (Counter(), Counter()))
                own = abbreviations.get(lang, none)
                for unit in (_LINE if bound else _BLANK).split(t or ""):
                    tokens = unit.split()
                    before = "."
                    for left, right in zip(tokens, tokens[1:]):
                        first, before = before in ends, left[-1]
                        last = left[-1]
                        if last not in ends:
                            if right[0].isupper() or right[0].isdigit():
                                mid[right] += 1
                        elif last == ".":
                            if left[-2:-1] in MARKS + "…" or right[0].islower():
                                continue
                            if (k := _next_type(left)) == NUMBER and first:  # a list marker
                                continue
                            if k == NUMBER or (k is not None and (k in common or k in own)):
                                if (r := _next_type(right)) is not None:
                                    out["p", lang, k, r] += 1
                            elif k is not None and len(k) > 1:
                                starts[right] += 1
                        elif last in MARKS and not right[0].islower():
                            starts[right] += 1
                if t and _CJK.search(t):
                    for w in _CJK_START.findall(t):
                        out["c", lang, "", w] += 1
            for lang, counters in seen.items():
                for kind, found in zip("sm", counters):
                    for w, n in found.items():
                        if (r := _next_type(w)) is not None:
                            out[kind, lang, "", r] += n
            keys = list(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([NUMBER if k[3] == NUMBER else _script(k[3]) for k in keys], pa.string()), *(pa.array([k[i] for k in keys], pa.string()) for i in (1, 2, 3)), pa.array([out[k] for k in keys], pa.int64())],
                names=["kind", "script", "lang", "left", "right", "n"],
            )

    return _with_languages(_texts(docs, text, line_bound, language).mapInArrow(count, "kind string, script string, lang string, left string, right string, n bigint"), "n")


def _ratio(k1: float, n1: float, k2: float, n2: float) -> float:
    """Dunning's log-likelihood ratio that k1 of n1 and k2 of n2 have one rate."""

    def ll(k: float, n: float, p: float) -> float:
        p = min(max(p, 1e-12), 1 - 1e-12)
        return k * math.log(p) + (n - k) * math.log(1 - p)

    if not n1 or not n2:
        return 0.0
    p = (k1 + k2) / (n1 + n2)
    return 2 * (ll(k1, n1, k1 / n1) + ll(k2, n2, k2 / n2) - ll(k1, n1, p) - ll(k2, n2, p))


def _ratio_column(k1: Column, n1: Column, k2: Column, n2: Column) -> Column:
    """:func:`_ratio` of columns."""
    def ll(k: Column, n: Column, p: Column) -> Column:
        p = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
        return k * F.ln(p) + (n - k) * F.ln(1 - p)

    p = (k1 + k2) / (n1 + n2)
    return F.when((n1 > 0) & (n2 > 0), 2 * (ll(k1, n1, k1 / n1) + ll(k2, n2, k2 / n2) - ll(k1, n1, p) - ll(k2, n2, p))).otherwise(0.0)


def _by_script(values: dict[str, float]) -> Column:
    """A value for each script (and language), 0 for others."""
    if not values:
        return F.lit(0.0)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for s, v in values.items() for x in (s, float(v))]), F.col("script")), F.lit(0.0))


def _next_words(follows: DataFrame, words: DataFrame, totals: dict[tuple[str, str], tuple[int, int]]) -> tuple[set[tuple[str, str]], set[tuple[str, str]], set[tuple[str, tuple[str, str]]]]:
    """(starters, inner types, collocations), each with its script. In scripts with case a type amid a sentence counts only if capital, since a small letter after a point tells by itself."""
    base, lang = F.substring_index("script", "|", 1), F.when(F.instr("script", "|") > 0, F.substring_index("script", "|", -1)).otherwise("")
    n_start = {r.script: r.n for r in follows.where("kind = 's'").groupBy("script").agg(F.sum("n").alias("n")).collect()}  # scripts and languages
    n_all = {s: c1 + c2 for (k, s), (c1, c2) in totals.items() if k == "w"}
    for counts in (n_start, n_all):
        whole: Counter[str] = Counter()
        for s, n in counts.items():
            whole[_key(NUMBER, _language(s))] += n
        counts.update(whole)
    n_mid = {s: max(n - n_start.get(s, 0), 0) for s, n in n_all.items()}
    counted = follows.where("kind in ('s', 'm')").groupBy("script", "right").agg(F.sum(F.when(F.col("kind") == "s", F.col("n")).otherwise(0)).alias("s"), F.sum(F.when(F.col("kind") == "m", F.col("n")).otherwise(0)).alias("m"))
    pairs = follows.where("kind = 'p'")
    every = counted.join(pairs.groupBy("script", "right").agg(F.sum("n").alias("p")), ["script", "right"], "full").join(words.select("script", F.col("type").alias("right"), (F.col("c1") + F.col("c2")).alias("w")), ["script", "right"], "left")
    s, m, p, w = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("s", "m", "p", "w"))
    least = F.when(lang != "", STARTER_RATIO).otherwise(LEAST_RATIO)  # what a language adds to its script is tested once more, on fewer words
    cased = base.isin("latin", "cyrillic", NUMBER)
    rates = every.select("script", "right", s.alias("s"), F.when(cased, m).otherwise(F.greatest(w - s - p, F.lit(0.0))).alias("m"), p.alias("p"), _by_script(n_start).alias("ns"), _by_script(n_mid).alias("nm")).where("ns > 0 and nm > 0")
    rates = materialize(rates.withColumn("ratio", _ratio_column(F.col("s"), F.col("ns"), F.col("m"), F.col("nm"))), "p9rates")
    starters = _collect(rates.where((F.col("ratio") >= STARTER_RATIO) & (F.col("s") / F.col("ns") > TIMES * F.col("m") / F.col("nm"))).select("script", "right"))
    inner = _collect(rates.where((F.col("p") > 0) & (F.col("ratio") > least) & (TIMES * F.col("s") / F.col("ns") < F.col("m") / F.col("nm"))).select("script", "right"))
    own = pairs.groupBy("left", "script").agg(F.sum("n").alias("nl"))
    numbers = own.groupBy("left", lang.alias("_l")).agg(F.sum("nl").alias("nl")).select("left", F.when(F.col("_l") != "", F.concat_ws("|", F.lit(NUMBER), "_l")).otherwise(NUMBER).alias("script"), "nl")
    own = own.where(base != NUMBER).unionByName(numbers)
    near = pairs.join(own, ["left", "script"]).join(rates.drop("ratio", "p"), ["script", "right"]).select("script", "left", "right", F.col("n").cast("double").alias("n"), F.col("nl").cast("double").alias("nl"), "s", "ns", "m", "nm")
    at, start, mid = F.col("n") / F.col("nl"), F.col("s") / F.col("ns"), F.col("m") / F.col("nm")
    bound = (at > TIMES * start) & (at > mid) & (_ratio_column(F.col("n"), F.col("nl"), F.col("s"), F.col("ns")) > F.when(F.col("left") == NUMBER, STARTER_RATIO).otherwise(least)) & (_ratio_column(F.col("n"), F.col("nl"), F.col("m"), F.col("nm")) > least)
    return {(r.script, r.right) for r in starters}, {(r.script, r.right) for r in inner}, {(r.script, (r.left, r.right)) for r in _collect(near.where(bound).select("script", "left", "right"))}


def _collect(df: DataFrame) -> list:
    rows = df.limit(MODEL_LIMIT + 1).collect()
    if len(rows) > MODEL_LIMIT:
        raise ValueError(f"more than {MODEL_LIMIT} learnt types; raise the thresholds")
    return rows


def learn(docs: DataFrame, text: str = "text", line_bound: str = "source is null or source != 'ocr_scan'", language: str = "lang") -> Models:
    """Learn :class:`Models` from all documents; counting is distributed, only types that pass a threshold reach the driver."""
    counts = materialize(_counts(docs, text, line_bound, language), "p9counts")
    totals = {(r.kind, r.script): (r.c1, r.c2) for r in counts.groupBy("kind", "script").agg(F.sum("c1").alias("c1"), F.sum("c2").alias("c2")).collect()}  # kinds x scripts and languages
    words = counts.where("kind = 'w'")

    rate = _by_script({s: min(max(c1 / (c1 + c2), 1e-6), 0.9) for (k, s), (c1, c2) in totals.items() if k == "w" and c1 + c2})
    dots, size = (_by_script({s: f(*c) for (k, s), c in totals.items() if k == "w"}) for f in (lambda c1, c2: c1, lambda c1, c2: c1 + c2))
    n1, n2 = F.col("c1").cast("double"), F.col("c2").cast("double")
    null = n1 * F.ln("p") + n2 * F.ln(1 - F.col("p"))
    alternative = n1 * F.ln(F.lit(0.99)) + n2 * F.ln(F.lit(0.01))
    inner = F.length("type") - F.length(F.replace("type", F.lit("."), F.lit("")))
    letters = F.length("type") - inner
    score = 2 * (alternative - null) * F.exp(-letters) * (inner + 1) * F.pow(F.greatest(letters, F.lit(1)).cast("double"), -n2)
    evidence = _ratio_column(n1, n1 + n2, dots - n1, size - n1 - n2)
    scored = words.where((F.col("c1") >= LEAST_COUNT) & ((evidence > LEAST_RATIO) | (size == n1 + n2))).withColumn("p", rate).withColumn("score", score).where(F.col("score") >= ABBREVIATION_SCORE)
    scored = materialize(scored.select("script", "type", "c1"), "p9abbreviations")
    abbreviations = {(r.script, r.type): r.c1 for r in _collect(scored)}

    near = _collect(counts.where("kind = 'e'").select("script", "type", F.col("c1").alias("e")).join(scored, ["script", "type"]))
    closing = set()
    at_ends = {(r.script, r.type): r.e for r in near}
    # never at a line end, though as often pointed as would have put a closing one there
    leading = {(s, t) for (s, t), c1 in abbreviations.items() if not at_ends.get((s, t)) and _ratio(0, c1, CLOSING_SHARE * totals.get(("e", s), (0, 0))[0], totals["w", s][0]) > LEAST_RATIO}
    own_dots: Counter[str] = Counter()
    own_ends: Counter[str] = Counter()
    for (s, _), c in abbreviations.items():
        own_dots[s] += c
    for r in near:
        own_ends[r.script] += r.e
    for r in near:
        all_ends, all_dots = totals["e", r.script][0], totals["w", r.script][0]
        own, others = own_dots[r.script], max(1, all_dots)
        usual = all_ends / max(1, others - own)
        share = r.e / r.c1
        rest_e, rest_n = own_ends[r.script] - r.e, own - r.c1
        if share >= CLOSING_SHARE * min(1.0, usual) and _ratio(r.e, r.c1, rest_e, max(rest_n, 1)) > LEAST_RATIO and share * max(rest_n, 1) > 2 * rest_e:
            closing.add((r.script, r.type))

    def by_language(found: Iterable[tuple]) -> dict[str, frozenset]:
        out: dict[str, set] = {}
        for s, x in found:
            out.setdefault(_language(s), set()).add(x)
        return {k: frozenset(v) for k, v in out.items()}

    known = by_language(abbreviations)
    follows = materialize(_follows(docs, text, line_bound, language, known), "p9follows")
    # a quotative is commoner after quotations than elsewhere, and than after sentence ends, where every starter is common
    quoted = counts.where("kind = 'q'").select("script", "type", F.col("c1").cast("double").alias("q")).where(F.col("q") >= LEAST_COUNT)
    base = counts.where("kind in ('w', 'c')").groupBy("script", "type").agg(F.sum(F.col("c1") + F.col("c2")).cast("double").alias("n"))
    begins = follows.where("kind in ('s', 'c')").groupBy("script", F.col("right").alias("type")).agg(F.sum("n").cast("double").alias("s"))
    n_quoted = _by_script({s: c for (k, s), (c, _) in totals.items() if k == "q"})
    n_base = _by_script({s: c1 + c2 for (k, s), (c1, c2) in totals.items() if k == ("c" if s.partition("|")[0] == "cjk" else "w")})
    n_begins = _by_script({r.script: r.s for r in begins.groupBy("script").agg(F.sum("s").alias("s")).collect()})
    rest, s = F.greatest(F.coalesce("n", F.lit(0.0)) - F.col("q"), F.lit(0.0)), F.coalesce("s", F.lit(0.0))
    n_rest = F.greatest(n_base - n_quoted, F.lit(1.0))
    common = (F.col("q") / n_quoted > TIMES * rest / F.greatest(n_base, F.lit(1.0))) & (_ratio_column(F.col("q"), n_quoted, F.least(rest, n_rest), n_rest) > LEAST_RATIO)
    no_starter = (n_begins == 0) | ((F.col("q") * n_begins > TIMES * s * n_quoted) & (_ratio_column(F.col("q"), n_quoted, s, n_begins) > LEAST_RATIO))
    quotatives = [(r.script, r.type) for r in _collect(quoted.join(base, ["script", "type"], "left").join(begins, ["script", "type"], "left").where(common & no_starter).select("script", "type"))]
    fields = [known, *map(by_language, (closing, quotatives, leading, *_next_words(follows, words, totals)))]
    models = {lang: Model(*(f.get(lang, frozenset()) for f in fields)) for lang in {"", *(k for f in fields for k in f)}}
    return Models(models.pop(""), models)


def _pairs(text: str, events: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Outermost matched quotations and brackets as (opening, closing) positions."""
    stack: list[tuple[str, int]] = []
    found: list[tuple[int, int]] = []
    for at, _ in events:
        c = text[at]
        if c in _CLOSE and (o := _CLOSE[c]) in (x for x, _ in stack):
            if c == "’" and at + 1 < len(text) and text[at + 1].isalpha() and text[at - 1].isalpha():
                continue
            while stack[-1][0] != o:
                stack.pop()
            start = stack.pop()[1]
            while found and found[-1][0] > start:
                found.pop()
            found.append((start, at))
        elif c in _OPEN:
            stack.append((c, at))
    return found


def _is_abbreviation(token: str, m: Model) -> bool:
    token = _FORMAT.sub("", token)
    return token.casefold() in m.abbreviations or (len(token) == 1 and token.isupper())


def _abbreviation_closes(token: str, text: str, after: int, stop: int, m: Model) -> bool:
    """Whether the sentence ends with the abbreviation ``token``, going by the word at or after ``after``."""
    token = _FORMAT.sub("", token).casefold()
    nxt = _INK.search(text, after, stop)
    if nxt is None:
        return token in m.closing
    i = j = nxt.start()
    if text[i].islower() or text[i] in ",;:":
        return False
    while j < stop and not text[j].isspace():
        j += 1
    follower = _next_type(text[i:j])
    if (token, follower) in m.collocations:
        return False
    if token in m.closing:
        return follower not in m.inner
    return len(token) > 1 and token not in m.leading and follower in m.starters


def _left_token(text: str, start: int, at: int) -> tuple[str, int]:
    """The token that the point at ``at`` ends, with its start."""
    i = at
    while i > start and not text[i - 1].isspace() and (text[i - 1] not in _STRIP_L[:-3] or (text[i - 1] in "'-" and i - 1 > start and text[i - 2].isalpha())):
        i -= 1
    return text[i:at], i


def _ends_at_point(text: str, sent: int, at: int, stop: int, m: Model) -> bool:
    """Whether the single point at ``at`` ends the sentence that starts at ``sent``."""
    token, began = _left_token(text, sent, at)
    after = text[at + 1] if at + 1 < stop else " "
    if not after.isspace() and after not in _CLOSERS and after not in _OPEN:
        if after in ",;:%/-–—=":
            return False
        if not token:
            return True
        j = at + 1
        while j < stop and not text[j].isspace() and text[j] not in _CLOSERS and text[j] not in _OPEN:
            j += 1
        chunk = text[began:j]
        if text[at - 1].isdigit() and after.isdigit():
            return False
        if _ADDRESS.match(chunk.rstrip(".,;:!?।…")):
            return False
        if _is_abbreviation(token, m):
            return False
        parts, done = chunk.split("."), len(token.split("."))
        return not any(".".join(parts[:k]).casefold() in m.abbreviations for k in range(done + 1, len(parts) + 1))
    if not token:
        return True
    if began == sent and token.isdigit() and len(token) <= 3:
        return False
    if _is_abbreviation(token, m):
        return _abbreviation_closes(token, text, at + 1, stop, m)
    if token[-1].isdigit() and (nxt := _NEXT.match(text, at + 1, stop)):
        return (NUMBER, _next_type(nxt[1])) not in m.collocations
    return True


@lru_cache(1)
def _uses_capitals(text: str, abbreviations: frozenset[str]) -> bool:
    """Whether sentences of this text start with capitals (informal Roman Telugu often has small letters), so that a small letter tells that one goes on."""
    starts = [c.isupper() for w, c in _CASE.findall(text) if w.casefold() not in abbreviations]
    return sum(starts) >= LEAST_COUNT and sum(starts) >= 0.9 * len(starts)


def _goes_on(text: str, at: int, stop: int, m: Model) -> bool:
    """Whether the sentence goes on after a quotation that closes just before ``at``."""
    nxt = _INK.search(text, at, stop)
    if nxt is None:
        return False
    i = nxt.start()
    if text[i] in ",;:" or text[i] in MARKS or (text[i].islower() and _uses_capitals(text, m.abbreviations)):
        return True
    if _CJK.match(text, i):
        return text[i] in m.quotatives
    j = i
    while j < stop and not text[j].isspace():
        j += 1
    k = _word_type(text[i:j])
    return k is not None and k[0] in m.quotatives


def _unit(text: str, start: int, stop: int, m: Model, out: list[tuple[int, int]]) -> None:
    first = _INK.search(text, start, stop)
    if first is None:
        return
    sent = first.start()
    while text[stop - 1].isspace():
        stop -= 1
    events = [e.span() for e in _EVENT.finditer(text, sent, stop)]
    if not events or (len(events) == 1 and events[0][1] == stop):
        out.append((sent, stop))
        return
    marks = [e for e in events if text[e[0]] in MARKS or text[e[0]] == "…"]
    pairs = _pairs(text, [e for e in events if not (text[e[0]] in MARKS or text[e[0]] == "…")])
    opened = {a for a, _ in pairs}
    todo = sorted([(a, b, False) for a, b in marks] + [(a, b, True) for a, b in pairs])
    until = sent
    if b := _BULLET.match(text, sent, stop):
        until = b.end()
        body = b.end()
    else:
        body = sent
    for a, b, is_pair in todo:
        if a < until or a < sent:
            continue
        if is_pair:
            until = end = b + 1
            before = b - 1
            while before > a and (text[before].isspace() or text[before] in _CLOSERS):
                before -= 1
            run = before
            while run > a and text[run - 1] in MARKS + "…":
                run -= 1
            if text[before] not in MARKS or text[run : before + 1] in ("..", "...", "...."):
                continue
            if text[run : before + 1] == "." and _is_abbreviation(token := _left_token(text, a, before)[0], m) and not _abbreviation_closes(token, text, end, stop, m):
                continue
            if text[a] in BRACKETS:
                nxt = text[end] if end < stop else " "
                if a != body or nxt in MARKS or nxt in ",;:":
                    continue
            elif _goes_on(text, end, stop, m):
                continue
        else:
            mark = text[a:b]
            if "…" in mark or (len(mark) > 1 and not mark.strip(".")):
                if not mark.strip("….") or mark[-1] in ".…":
                    continue
            if mark == "." or mark == "．":
                if not _ends_at_point(text, body if text[sent:body].strip() else sent, a, stop, m):
                    continue
            elif b < stop and not text[b].isspace() and text[b] not in _CLOSERS:
                i, j = a, b
                while i > sent and not text[i - 1].isspace():
                    i -= 1
                while j < stop and not text[j].isspace():
                    j += 1
                if text[b].isascii() and _ADDRESS.match(text[i:j].lstrip(_STRIP_L).rstrip(_STRIP_R + ".")):
                    continue
                if text[b] in ",;:":
                    continue
            end = b
        while end < stop and text[end] in _CLOSERS and end not in opened:
            end += 1
        if end < stop and text[end] == "[" and (f := regex.match(r"\[\d{1,3}\]", text[end:stop])):
            end += f.end()
        out.append((sent, end))
        nxt = _INK.search(text, end, stop)
        if nxt is None:
            return
        sent = body = nxt.start()
        until = max(until, sent)
        if (k := _BULLET.match(text, sent, stop)) and text[end:sent]:
            body = until = k.end()
    out.append((sent, stop))


def sentence_spans(text: str, breaks_end: bool, m: Model) -> list[tuple[int, int]]:
    """(start, end) of each sentence in code points, end exclusive."""
    out: list[tuple[int, int]] = []
    at = 0
    for gap in (_LINE if breaks_end else _BLANK).finditer(text):
        _unit(text, at, gap.start(), m, out) if gap.start() > at else None
        at = gap.end()
    if at < len(text):
        _unit(text, at, len(text), m, out)
    return out


def sentences(docs: DataFrame, model: Model | Models | None = None, *, id_col: str = "doc_id", text: str = "text", line_bound: str = "source is null or source != 'ocr_scan'", language: str = "lang") -> DataFrame:
    """(doc_id, sent_start, sent_end): the sentences of every document, without outer white space.

    Null, empty and blank texts have none. Line breaks end a sentence where ``line_bound``
    holds, blank lines always. Documents are independent, so nothing is shuffled in this pass.
    The model is learnt from ``docs`` when none is given. Without a ``language`` column, or
    where it is null, the lists of all documents alone are used.
    """
    m = learn(docs, text, line_bound, language) if model is None else model
    m = m if isinstance(m, Models) else Models(m, {})
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[str, Model] = {}
        for b in batches:
            rows, spans = [], []
            for i, (t, bound, lang) in enumerate(zip(*(b.column(k).to_pylist() for k in (1, 2, 3)))):
                if t:
                    if (own := of.get(lang)) is None:
                        own = of[lang] = m.of(lang)
                    got = sentence_spans(t, bound, own)
                    spans += got
                    rows += [i] * len(got)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array([s for s, _ in spans], pa.int64()), pa.array([e for _, e in spans], pa.int64())], names=[id_col, "sent_start", "sent_end"])

    lang = F.coalesce(F.lower(F.trim(F.col(language))), F.lit("")) if language in docs.columns else F.lit("")
    return docs.select(id_col, F.col(text).alias("_t"), F.expr(line_bound).alias("_b"), lang.alias("_l")).mapInArrow(cut, f"`{id_col}` {kind}, sent_start bigint, sent_end bigint")


def sentence_counts(docs: DataFrame, **options) -> DataFrame:
    """(source, documents, sentences, mean_chars): sentences per source of :func:`sentences`."""
    cut = sentences(docs, **options).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("sent_end") - F.col("sent_start")).alias("chars"))
    return docs.select("doc_id", "source").join(cut, "doc_id", "left").groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("sentences"), (F.sum("chars") / F.sum("n")).alias("mean_chars"))
