"""Defects of prompt and response pairs: empty, refusal, copied, other language, truncated.

Copies are decided by zstandard: how much of the prompt's size is left when it is compressed
with the response as a dictionary (that way round, a label in front of a copy costs nothing). Refusals and placeholders come from dictionaries; that of refusals
grows by phrases that go with its entries in the table itself. Language comes from a
dictionary of scripts over the words that the prompt does not explain. Truncation is decided
by a terminal-context model: the consonant skeleton of the response is aligned with the
prompt's, and a logistic regression over the end of the alignment, fitted on responses of the
table that were cut or left whole, gives the chance that two or more words are lacking.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lekha.functions.canonical import words_of

DEFECTS = ("empty", "refusal", "copied", "other_language", "truncated")

#: What stands for no answer, and the words of refusals (canonical words).
PLACEHOLDERS = frozenset("null|none|n a|na|nan|nil|undefined|empty|blank|tbd|todo|placeholder|no output|no response|no answer|not available|unknown".split("|"))
REFUSALS = (
    "sorry", "apologies", "apologize", "apologise", "unfortunately", "cannot", "can t", "cant", "won t", "will not", "not able", "unable", "not possible", "not allowed", "language model", "an ai", "decline",
    "kshaminchandi", "kshamimchandi", "mannimchandi", "manninchandi", "sorry andi", "maarchalenu", "marchalenu", "raayalenu", "rayalenu", "cheyalenu", "kudaradu", "saadhyam kaadu", "anumathi ledu",
    "క్షమించండి", "మన్నించండి", "అర్థం చేసుకోండి", "సాధ్యం కాదు", "వీలు కాదు", "మార్చలేను", "రాయలేను", "చేయలేను", "చేయలేకపోతున్నాను", "అనుమతి లేదు", "కుదరదు",
)
#: The script dictionary, script -> language that it stands for.
SCRIPT_LANGUAGES = {"Telugu": "te", "Latin": "latin", "Devanagari": "hi", "Kannada": "kn", "Malayalam": "ml", "Tamil": "ta", "Bengali": "bn", "Gujarati": "gu", "Gurmukhi": "pa", "Oriya": "or", "Arabic": "ar", "Han": "zh", "Hiragana": "ja", "Katakana": "ja", "Hangul": "ko", "Cyrillic": "ru"}

#: A prompt of which a dictionary of the response leaves at most this share of its compressed size is copied.
COPY_SHARE = 0.45
#: Words of a refusal that the prompt explains, at most; end words that a truncated response lacks, at least.
EXPLAINED_MOST, LACKING_LEAST = 0.6, 2
#: Words of a learnt phrase, its rows and log-likelihood ratio at least, and its share of rows with refusals at least.
PHRASE, LEAST_COUNT, LEAST_RATIO, LEAST_SHARE = 3, 5, 10.8, 0.9
#: Learnt phrases beyond this number are refused rather than shipped to every task.
MODEL_LIMIT = 100_000
#: The terminal-context model is fitted on at most this many rows, those of the smallest hashes.
FIT_ROWS = 4000

#: Consonant classes shared by both scripts: aspiration, length, retroflexion and the sibilants are not told apart.
_TELUGU = {c: k for k, cs in {"k": "కఖ", "g": "గఘ", "n": "ఙఞణనమంఁ", "c": "చఛ", "j": "జఝ", "t": "టఠతథ", "d": "డఢదధ", "p": "పఫ", "b": "బభ", "y": "య", "r": "రఱ", "l": "లళఴ", "v": "వ", "s": "శషస", "h": "హ", "a": "అఆఇఈఉఊఋఎఏఐఒఓఔ"}.items() for c in cs}
_ROMAN = {c: k for k, cs in {"k": "kq", "g": "g", "n": "nm", "c": "c", "j": "jz", "t": "t", "d": "d", "p": "pf", "b": "b", "y": "y", "r": "r", "l": "l", "v": "vw", "s": "sx", "h": "h", "a": "aeiou"}.items() for c in cs}
_CLASS = _TELUGU | _ROMAN | {d: d for d in "0123456789"}
_LETTER = regex.compile(r"\p{L}")
_LATIN = regex.compile(r"\p{Latin}")
_CUES = tuple(words_of(REFUSALS))
_TELUGU_LETTER = regex.compile(r"(?=\p{L})[ఀ-౿]")
_SCRIPTS = [(lang, regex.compile(rf"(?=\p{{L}})\p{{{name}}}")) for name, lang in SCRIPT_LANGUAGES.items()]


@lru_cache(1 << 16)
def skeleton(word: str) -> str:
    """Consonant classes of a canonical word; vowels and h only count at its start (written vowel letters of Telugu anywhere)."""
    out = ""
    for i, c in enumerate(word):
        k = _CLASS.get(c)
        if k is None or (i and (k == "h" or (k == "a" and c.isascii()))) or out[-1:] == k:
            continue
        out += k
    return out


def alignment(whole: str, said: str) -> tuple[int, int]:
    """(end, edits): the longest beginning of ``whole`` of the least edit distance to ``said``, by bit vectors over ``said`` (Myers)."""
    m = len(said)
    if not m:
        return 0, 0
    full, top = (1 << m) - 1, 1 << (m - 1)
    at: dict[str, int] = {}
    for i, c in enumerate(said):
        at[c] = at.get(c, 0) | 1 << i
    plus, minus, cost, least, end = full, 0, m, m, 0
    for j, c in enumerate(whole, 1):
        eq = at.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph, mh = minus | (full & ~(xh | plus)), plus & xh
        cost += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1 | 1) & full, mh << 1 & full
        plus, minus = mh | (full & ~(xv | ph)), ph & xv
        if cost <= least:
            least, end = cost, j
    return end, least


class Ending(NamedTuple):
    """Terminal context of a response: words at the end of the prompt that it lacks, edits per skeleton letter of it, and the share of the prompt's skeleton behind the alignment."""

    lack: int
    rate: float
    rest: float


def ending(prompt: list[str], response: list[str]) -> Ending:
    parts = [skeleton(w) for w in prompt]
    whole, said = "".join(parts), "".join(skeleton(w) for w in response)
    if whole == said:
        return Ending(0, 0.0, 0.0)
    end, least = alignment(whole, said)
    lack, stop = 0, len(whole)
    for p in reversed(parts):
        start = stop - len(p)
        if (start < end and 2 * (end - start) >= len(p)) or (not p and start <= end):
            break
        lack, stop = lack + 1, start
    return Ending(lack, least / max(1, len(said)), (len(whole) - end) / max(1, len(whole)))


#: What the weights are before any row is seen, and how many rows that is worth: two lacking words, and few edits.
PRIOR, PRIOR_ROWS = (-6.0, 0.0, 12.0, 0.0, -15.0, 0.0), 5.0


def _features(e: Ending) -> tuple[float, ...]:
    return (1.0, float(e.lack >= 1), float(e.lack >= LACKING_LEAST), float(e.lack > LACKING_LEAST), min(e.rate, 1.0), e.rest)


class Model(NamedTuple):
    """Learnt refusal phrases (canonical words) and the weights of the terminal-context model."""

    phrases: frozenset[str] = frozenset()
    weights: tuple[float, ...] = PRIOR

    def truncated(self, e: Ending) -> float:
        """Chance that a response of this ending is truncated."""
        z = sum(w * x for w, x in zip(self.weights, _features(e)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def endings_to_fit(pairs: list[tuple[list[str], list[str]]], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(features, truncated) made of pairs: the response as it stands, without its last word, cut by two words and more, cut within a word, and the response of another pair. Only responses that end where their prompt ends are used."""
    draw = random.Random(seed)
    xs, ys = [], []

    def add(p: list[str], r: list[str], y: bool) -> None:
        xs.append(_features(ending(p, r)))
        ys.append(float(y))

    for i, (p, r) in enumerate(pairs):
        e = ending(p, r)
        if len(r) < 4 or e.lack or e.rate > 0.4:
            continue
        add(p, r, False)
        add(p, r[:-1], False)
        keep = draw.randint(1, len(r) - LACKING_LEAST)
        add(p, r[:keep], True)
        keep = draw.randint(0, len(r) - LACKING_LEAST - 1)
        add(p, [*r[:keep], r[keep][: max(2, len(r[keep]) * 2 // 3)]], True)
        add(p, pairs[i - 1][1], False)
    return np.array(xs).reshape(-1, len(PRIOR)), np.array(ys)


def fit_weights(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton steps, drawn to PRIOR with the weight of PRIOR_ROWS rows."""
    prior = np.array(PRIOR)
    w = prior.copy()
    pull = np.eye(len(prior)) * PRIOR_ROWS / 25
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (q * (1 - q))[:, None]) + pull, x.T @ (q - y) + pull @ (w - prior))
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


_PREAMBLE = bytes(range(1, 33))  # in front of data and dictionary, so that the cost of a frame with a match is in every size


def compressed(data: bytes, dictionary: bytes = b"") -> int:
    """Size of ``data`` as a bare zstandard frame with a raw dictionary, both behind a preamble, so that texts of any length can match."""
    data, dictionary = _PREAMBLE + data, _PREAMBLE + dictionary
    how = zstandard.ZstdCompressionParameters.from_level(19, source_size=len(data), dict_size=len(dictionary), min_match=3, write_checksum=False, write_content_size=False)
    return len(zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)).compress(data))


_FRAME = compressed(b"")


def unexplained(prompt: str, response: str) -> float:
    """Share of the prompt's compressed size that is left with the response as dictionary: near 0 for a copy, also behind a label or with a changed word, near 1 for another text."""
    data, known = prompt.replace(" ", "").encode("utf-8", "surrogatepass"), response.replace(" ", "").encode("utf-8", "surrogatepass")
    return (compressed(data, known) - _FRAME) / max(1, compressed(data) - _FRAME)


def is_copy(prompt: str, response: str) -> bool:
    """Whether a response, from its first Latin letter on, is mostly Latin and holds the prompt."""
    start = _LATIN.search(response)
    if not prompt or not start or not _LATIN.search(prompt):
        return False
    said = response[start.start() :]
    return len(_LATIN.findall(said)) * 2 > len(_LETTER.findall(said)) and unexplained(prompt, said) <= COPY_SHARE


def language(words: list[str]) -> str | None:
    """The language of most letters of words, by the script dictionary; None without letters, other for scripts it does not have."""
    text = "".join(words)
    found = Counter({lang: 0 for lang in SCRIPT_LANGUAGES.values()})
    for lang, p in _SCRIPTS:
        found[lang] += len(p.findall(text))
    found["other"] = len(_LETTER.findall(text)) - found.total()
    top = max(found.items(), key=lambda x: x[1])
    return top[0] if top[1] else None


def _explained(response: list[str], given: set[str], shapes: set[str]) -> float:
    return sum(w in given or skeleton(w) in shapes for w in response) / len(response)


def _is_refusal(prompt: str, response: str, given: set[str], shapes: set[str], cues: tuple[str, ...], phrases: frozenset[str]) -> bool:
    """Whether a response the prompt hardly explains holds a cue or learnt phrase that is not the prompt's."""
    said, asked, r = f" {response} ", f" {prompt} ", response.split(" ")
    hits = [c for c in cues if f" {c} " in said]
    if phrases:
        hits += [t for i in range(len(r) - PHRASE + 1) if (t := " ".join(r[i : i + PHRASE])) in phrases]
    return bool(hits) and _explained(r, given, shapes) <= EXPLAINED_MOST and any(f" {c} " not in asked and not all(skeleton(w) in shapes for w in c.split()) for c in hits)


def defect(prompt: str, response: str, model: Model = Model()) -> str | None:
    """The first defect that holds, from the canonical words of both sides."""
    if not response or response in PLACEHOLDERS:
        return "empty"
    p, r = prompt.split(" ") if prompt else [], response.split(" ")
    given, shapes = set(p), {skeleton(w) for w in p}
    if _is_refusal(prompt, response, given, shapes, _CUES, model.phrases):
        return "refusal"
    if is_copy(prompt, response):
        return "copied"
    fresh = "".join([w for w in r if w not in given])
    if 2 * len(_TELUGU_LETTER.findall(fresh)) < len(_LETTER.findall(fresh)):
        return "other_language"
    e = ending(p, r)
    if e.lack and model.truncated(e) > 0.5:
        return "truncated"
    return None


def learn_phrases(df: DataFrame, prompt: str = "roman_text", response: str = "telugu_text") -> frozenset[str]:
    """Phrases of PHRASE words that go with the refusals of the dictionary, by log-likelihood ratio over all rows whose response the prompt hardly explains."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter[tuple[str | None, bool]] = Counter()
            for p, r in zip(words_of(b.column(0).to_pylist()), words_of(b.column(1).to_pylist())):
                words = r.split(" ")
                given = p.split(" ")
                shapes = {skeleton(w) for w in given}
                if len(words) < PHRASE or _explained(words, set(given), shapes) > EXPLAINED_MOST:
                    continue
                refused = _is_refusal(p, r, set(given), shapes, _CUES, frozenset())
                seen.update((t, refused) for t in {None, *(" ".join(words[i : i + PHRASE]) for i in range(len(words) - PHRASE + 1))})
            keys = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([seen[k] if k[1] else 0 for k in keys], pa.int64()), pa.array([0 if k[1] else seen[k] for k in keys], pa.int64())], names=["phrase", "a", "b"])

    found = df.select(F.col(prompt).alias("_p"), F.col(response).alias("_r")).mapInArrow(count, "phrase string, a bigint, b bigint").groupBy("phrase").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    rows = found.where(F.col("phrase").isNull() | ((F.col("a") >= LEAST_COUNT) & (F.col("a") >= LEAST_SHARE * (F.col("a") + F.col("b"))))).limit(MODEL_LIMIT + 1).collect()
    if len(rows) > MODEL_LIMIT:
        raise ValueError(f"more than {MODEL_LIMIT} learnt phrases; raise the thresholds")
    refused, other = next(((r.a, r.b) for r in rows if r.phrase is None), (0, 0))
    ll = lambda k, n: k * math.log(k / n) + (n - k) * math.log(1 - k / n) if 0 < k < n else 0.0
    ratio = lambda a, b: 2 * (ll(a, a + b) + ll(refused - a, refused + other - a - b) - ll(refused, refused + other))
    return frozenset(r.phrase for r in rows if r.phrase is not None and ratio(r.a, r.b) > LEAST_RATIO)


def learn(df: DataFrame, *, id_col: str = "seq", prompt: str = "roman_text", response: str = "telugu_text", fit_rows: int = FIT_ROWS) -> Model:
    """Refusal phrases from all rows, and the terminal-context model from at most ``fit_rows`` rows."""
    rows = df.where(F.col(prompt).isNotNull() & F.col(response).isNotNull()).select(F.col(id_col).alias("i"), F.col(prompt).alias("p"), F.col(response).alias("r"))
    sample = rows.orderBy(F.xxhash64("i"), "i", "p", "r").limit(fit_rows).collect()
    texts = zip(words_of([r.p for r in sample]), words_of([r.r for r in sample]))
    x, y = endings_to_fit([(p.split(" "), r.split(" ")) for p, r in texts if p and r])
    return Model(learn_phrases(df, prompt, response), fit_weights(x, y))


def labelled(df: DataFrame, model: Model | None = None, *, id_col: str = "seq", prompt: str = "roman_text", response: str = "telugu_text") -> DataFrame:
    """(seq, defect): every row with its defect, null for a faithful rendering.

    The model is learnt from ``df`` when none is given.

    Null responses are empty; with a null or unreadable prompt only the defects of the
    response itself can hold. Rows are judged alone by the same model, without a shuffle, so
    repeated rows get the same label each.
    """
    kind = df.schema[id_col].dataType.simpleString()
    m = learn(df, id_col=id_col, prompt=prompt, response=response) if model is None else model

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [defect(p, r, m) for p, r in zip(words_of(b.column(1).to_pylist()), words_of(b.column(2).to_pylist()))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())], names=[id_col, "defect"])

    return df.select(id_col, F.col(prompt).alias("_p"), F.col(response).alias("_r")).mapInArrow(judge, f"`{id_col}` {kind}, defect string")


def found(df: DataFrame, **options) -> DataFrame:
    """(seq, defect): the defective rows of :func:`labelled`."""
    return labelled(df, **options).where("defect is not null")


def counts(df: DataFrame, by: str = "category", id_col: str = "seq", **options) -> DataFrame:
    """(category, defect, rows): rows of each group and defect; faithful rows have a null defect. Identifiers must be unique."""
    return labelled(df, id_col=id_col, **options).join(df.select(id_col, by), id_col).groupBy(by, "defect").agg(F.count(F.lit(1)).alias("rows"))


def response_languages(df: DataFrame, model: Model | None = None, *, id_col: str = "seq", prompt: str = "roman_text", response: str = "telugu_text") -> DataFrame:
    """(language, rows): the languages of the other_language responses, kept words of the prompt aside."""
    m = learn(df, id_col=id_col, prompt=prompt, response=response) if model is None else model

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = Counter(language([w for w in r.split(" ") if w not in set(p.split(" "))]) for p, r in zip(words_of(b.column(0).to_pylist()), words_of(b.column(1).to_pylist())) if defect(p, r, m) == "other_language")
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.int64())], names=["language", "n"])

    return df.select(F.col(prompt).alias("_p"), F.col(response).alias("_r")).mapInArrow(name, "language string, n bigint").groupBy("language").agg(F.sum("n").alias("rows"))
