"""Text functions as Column expressions; only Unicode normalisation needs Python (Arrow)."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lekha.config import TELUGU, Junk, PairRatio, Script, SplitCuts

#: Unicode white space and the digits beyond Nd that count as digits.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
DIGIT = r"[\p{Nd}\x{b2}\x{b3}\x{b9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}]"


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode NFC; null stays null."""
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def remove_controls(c: Column) -> Column:
    """Without control characters, so that they join what they part; tab and line breaks stay."""
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, rf"{SPACE}+", " "))


def normalized(c: Column) -> Column:
    return collapse_spaces(remove_controls(nfc(c)))


def _share(c: Column, char_class: str) -> Column:
    n = F.char_length(c)
    return F.when(n > 0, F.char_length(F.regexp_replace(c, f"[^{char_class}]", "")) / n).otherwise(F.lit(0.0))


def script_share(c: Column, script: Script = TELUGU) -> Column:
    """Share of code points in the script; empty and null texts have 0."""
    return _share(c, script.char_class)


def is_mostly(c: Column, least: float = 0.3, script: Script = TELUGU) -> Column:
    return script_share(c, script) >= least


def detect_script(c: Column, script: Script = TELUGU) -> Column:
    return F.when(script_share(c, script) >= 0.4, "telugu").when(_share(c, "A-Za-z") >= 0.4, "roman").otherwise("mixed")


def length_ratio(roman: Column, telugu: Column) -> Column:
    n = F.char_length(F.coalesce(telugu, F.lit("")))
    return F.when(n > 0, F.char_length(F.coalesce(roman, F.lit(""))) / n).otherwise(F.lit(0.0))


def length_ratio_ok(roman: Column, telugu: Column, ratio: PairRatio = PairRatio()) -> Column:
    """Ratio within bounds, both inclusive; an empty second side never is."""
    return (F.char_length(F.coalesce(telugu, F.lit(""))) > 0) & length_ratio(roman, telugu).between(ratio.low, ratio.high)


def row_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def pair_key(telugu: Column, roman: Column) -> Column:
    side = lambda x: F.lower(strip(F.coalesce(x, F.lit(""))))
    return F.sha2(F.concat(side(telugu), F.lit("|||"), side(roman)), 256)


def split_key(telugu: Column) -> Column:
    return F.md5(F.lower(strip(F.coalesce(telugu, F.lit("")))))


def split_of_key(key: Column, cuts: SplitCuts = SplitCuts()) -> Column:
    v = F.conv(F.substring(key, 1, 4), 16, 10).cast("int")
    return F.when(v <= cuts.train, "train").when(v <= cuts.val, "val").otherwise("test")


def length_bucket(c: Column) -> Column:
    n = F.char_length(F.coalesce(c, F.lit("")))
    return F.when(n < 10, "short (<10)").when(n < 30, "medium (10-30)").when(n < 80, "long (30-80)").otherwise("very_long (80+)")


def draw(order: str, seed: int) -> Column:
    """A text of chance for each identifier, the same for the same seed."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.col(order)))


def cer(prediction: Column, reference: Column, empty_reference_is_zero: bool = False) -> Column:
    """Edit distance per reference character; an empty reference costs 0 for an empty prediction and else 1, or always 0."""
    p, r = F.coalesce(prediction, F.lit("")), F.coalesce(reference, F.lit(""))
    empty = F.lit(0.0) if empty_reference_is_zero else F.when(p == "", 0.0).otherwise(1.0)
    return F.when(r == "", empty).otherwise(F.levenshtein(p, r) / F.char_length(r))


def words(c: Column) -> Column:
    """Words parted by Unicode white space; an empty text has none."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), rf"{SPACE}+"), lambda w: w != "")


def word_codes(listed: Column, known: Column) -> Column:
    """Words as one character each, their place in ``known``, so that edit distance counts words.

    ``known`` should be a column of its own: an expression would be evaluated for every word.
    """
    code = lambda w: F.lpad(F.hex(F.array_position(known, w).cast("bigint") + 0xFFFF), 8, "0")
    return F.decode(F.unhex(F.array_join(F.transform(listed, code), "")), "UTF-32")


def with_word_edits(df: DataFrame, prediction: Column, reference: Column) -> DataFrame:
    """Adds word_edits and ref_words; the steps are columns of their own."""
    df = df.withColumns({"_p": words(prediction), "_r": words(reference)}).withColumn("_known", F.array_distinct(F.concat("_p", "_r")))
    codes = [word_codes(F.col(c), F.col("_known")) for c in ("_p", "_r")]
    return df.withColumns({"word_edits": F.levenshtein(*codes), "ref_words": F.size("_r")}).drop("_p", "_r", "_known")


def has_english_words(c: Column, share: float = 0.2) -> Column:
    """At least ``share`` of the words are ASCII letters, two or more."""
    w = words(c)
    return (F.size(w) > 0) & (F.size(F.filter(w, lambda x: x.rlike("^[A-Za-z]{2,}$"))) / F.size(w) >= share)


def has_listed_words(c: Column, listed: list[str]) -> Column:
    return F.arrays_overlap(F.transform(words(c), lambda w: F.regexp_replace(F.lower(w), r"^[.,!?]+|[.,!?]+$", "")), F.array(*map(F.lit, listed)) if listed else F.array().cast("array<string>"))


def is_clean_prompt(c: Column) -> Column:
    """8 to 60 characters, no digit or special character, at least 0.7 letters."""
    t = F.coalesce(c, F.lit(""))
    return F.char_length(t).between(8, 60) & ~t.rlike(r"[0-9@#$%^&*()\[\]{}|\\<>]") & (_share(t, r"\p{L}") >= 0.7)


def substitutions(prediction: Column, reference: Column) -> Column:
    """array<struct<ref, pred>>: characters that differ at the same position, up to the shorter text."""
    p, r = F.split(F.coalesce(prediction, F.lit("")), ""), F.split(F.coalesce(reference, F.lit("")), "")
    n = F.least(F.char_length(F.coalesce(prediction, F.lit(""))), F.char_length(F.coalesce(reference, F.lit(""))))
    both = F.arrays_zip(F.slice(r, 1, n).alias("ref"), F.slice(p, 1, n).alias("pred"))
    return F.filter(both, lambda x: x["ref"] != x["pred"])


def source_confidence(source: Column, score: Column) -> Column:
    known = F.when(source.isin("Dakshina", "Existing", "Wikidata"), 0.90).when(source == "Samanantar", 0.85)
    return known.when(score.isNotNull() & ~F.isnan(score), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 + score)), 4)).otherwise(0.75)


def json_object(c: Column) -> Column:
    """The part from the first ``{`` to the last ``}``, or null."""
    found = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.when(found != "", found)


def shorten_ey(c: Column) -> Column:
    return F.regexp_replace(c, r"(?i)(?<=[a-z])(e)y\b", "e")


# Vowel signs doubled by a vowel letter, and what stands instead.
_DOUBLED_SIGNS = (("ాఆ", "ా"), ("ిఇ", "ి"), ("ీఈ", "ీ"), ("ుఉ", "ు"), ("ూఊ", "ూ"), ("ెఎ", "ె"), ("ేఏ", "ే"), ("ొఒ", "ొ"), ("ోఓ", "ో"))


def fix_doubled_signs(c: Column) -> Column:
    return reduce(lambda x, ab: F.replace(x, F.lit(ab[0]), F.lit(ab[1])), _DOUBLED_SIGNS, c)


def repeats_one_char(c: Column, share: float) -> Column:
    """Whether one character makes more than ``share`` (0.5 or more) of a non-empty text.

    Such a character is the median of the sorted characters, so no character is counted but that one.
    """
    if share < 0.5:
        raise ValueError("only a majority is found through the median")
    n = F.char_length(c)
    median = F.get(F.array_sort(F.split(c, "")), F.floor(n / 2).cast("int"))
    return (n - F.char_length(F.replace(c, median, F.lit("")))) / n > share


def junk_reason(c: Column, junk: Junk = Junk()) -> Column:
    """The first rule that a text breaks, or null; null counts as empty."""
    t = F.coalesce(c, F.lit(""))
    bare = strip(t)
    n = F.char_length(t)
    return (
        F.when(F.char_length(bare) < junk.min_chars, "too_short")
        .when(n > junk.max_chars, "too_long")
        .when(bare.rlike(r"(?i)^(https?://|www\.)\S+$"), "url_only")
        .when(strip(F.regexp_replace(t, r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]+", "")) == "", "emoji_only")
        .when((n - F.char_length(F.regexp_replace(t, DIGIT, ""))) / n > junk.max_digit_share, "high_digit_ratio")
        .when((n >= junk.repeat_from_chars) & repeats_one_char(t, junk.max_repeat_share), "high_repeat")
    )


def synthetic_reason(roman: Column, telugu: Column, script: Script = TELUGU) -> Column:
    """Why a generated pair is refused, or null; sides are trimmed and the second is normalised first."""
    r, t = strip(F.coalesce(roman, F.lit(""))), nfc(strip(F.coalesce(telugu, F.lit(""))))
    n = F.char_length(r)
    ratio = n / F.greatest(F.char_length(t), F.lit(1))
    return (
        F.when(n < 3, "roman too short").when(n > 512, "roman too long").when(~r.rlike("[A-Za-z]"), "roman has no ASCII letters")
        .when((n - F.char_length(F.regexp_replace(r, DIGIT, ""))) / n > 0.5, "roman >50% digits")
        .when(script_share(t, script) < 0.10, "telugu density").when(~ratio.between(0.30, 4.00), "length ratio")
    )
