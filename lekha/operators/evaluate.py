"""Evaluation analytics over a frame of pairs with a ``prediction`` column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lekha.config import SLICES, TARGETS, EvalSlice
from lekha.functions import text

#: Pairs of at least this error rate fail.
FAILING = 0.20


def with_errors(df: DataFrame) -> DataFrame:
    """Adds cer, char_edits, ref_chars, word_edits, ref_words, exact; null texts count as empty."""
    p, r = F.coalesce("prediction", F.lit("")), F.coalesce("telugu_text", F.lit(""))
    out = text.with_word_edits(df, p, r).withColumns({"char_edits": F.levenshtein(p, r), "ref_chars": F.char_length(r), "exact": text.strip(p) == text.strip(r)})
    return out.withColumn("cer", F.when(F.col("ref_chars") > 0, F.col("char_edits") / F.col("ref_chars")).when(p == "", 0.0).otherwise(1.0))


_METRICS = lambda: [F.count(F.lit(1)).alias("count"), F.round(F.avg("cer"), 4).alias("cer"), F.round(F.sum("word_edits") / F.sum("ref_words"), 4).alias("wer"), F.round(F.avg(F.col("exact").cast("double")), 4).alias("exact_match")]


def overall(df: DataFrame) -> DataFrame:
    """(count, cer, wer, exact_match): macro character error, corpus word error, and exact share; nulls for an empty input."""
    return with_errors(df).agg(*_METRICS())


def micro_cer(df: DataFrame) -> DataFrame:
    """(cer): all edits over all reference characters; rows without prediction are left out."""
    return with_errors(df.where("prediction is not null")).agg((F.sum(F.when(F.col("ref_chars") > 0, F.col("char_edits")).otherwise(0)) / F.greatest(F.sum("ref_chars"), F.lit(1))).alias("cer"))


def slice_condition(s: EvalSlice) -> Column:
    roman = F.coalesce("roman_text", F.lit(""))
    tests = [F.char_length(roman) >= s.min_roman]
    if s.sources:
        tests.append(F.coalesce(F.col("source_name").isin(*s.sources), F.lit(False)))
    if s.pair_sources:
        tests.append(F.coalesce(F.col("pair_source").isin(*s.pair_sources), F.lit(False)))
    if s.english_share is not None:
        tests.append(text.has_english_words(roman, s.english_share))
    if s.english_words:
        tests.append(text.has_listed_words(roman, list(s.english_words)))
    return reduce(lambda a, b: a & b, tests)


def by_slice(df: DataFrame, slices: tuple[EvalSlice, ...] = SLICES) -> DataFrame:
    """(slice, count, cer, wer, exact_match): the whole set and each slice; a row may be in several, an empty slice has count 0 and nulls.

    Errors are computed once; rows are then repeated for their slices and aggregated on the map side.
    """
    spark = df.sparkSession
    member = F.array_compact(F.array(F.lit("overall"), *[F.when(slice_condition(s), F.lit(s.name)) for s in slices]))
    got = with_errors(df).select(F.explode(member).alias("slice"), "cer", "word_edits", "ref_words", "exact").groupBy("slice").agg(*_METRICS())
    names = spark.createDataFrame([("overall",), *[(s.name,) for s in slices]], "slice string")
    return F.broadcast(names).join(got, "slice", "left").withColumn("count", F.coalesce("count", F.lit(0)))


def confusion_summary(df: DataFrame) -> DataFrame:
    """(sample_size, failing_count, failing_rate, overall_cer); the error rate of a pair is rounded to 4 places before the threshold."""
    e = with_errors(df).select(F.round("cer", 4).alias("cer"))
    return e.agg(F.count(F.lit(1)).alias("sample_size"), F.count_if(F.col("cer") >= FAILING).alias("failing_count"), F.round(F.avg((F.col("cer") >= FAILING).cast("double")), 4).alias("failing_rate"), F.round(F.avg("cer"), 4).alias("overall_cer"))


def _failing(df: DataFrame) -> DataFrame:
    return with_errors(df).withColumn("cer", F.round("cer", 4)).where(F.col("cer") >= FAILING)


def confusion_groups(df: DataFrame) -> DataFrame:
    """(section, key, count, avg_cer): failing pairs by source, by length of the prompt, and by pair source, in one pass."""
    keys = [("by_source", F.coalesce("source_name", F.lit(""))), ("by_length", text.length_bucket(F.col("roman_text"))), ("by_pair_source", F.coalesce("pair_source", F.lit("")))]
    rows = _failing(df).select("cer", F.explode(F.array(*[F.struct(F.lit(n).alias("section"), k.alias("key")) for n, k in keys])).alias("k"))
    return rows.groupBy("k.section", "k.key").agg(F.count(F.lit(1)).alias("count"), F.round(F.avg("cer"), 4).alias("avg_cer"))


def top_char_errors(df: DataFrame, top: int = 20, order: str = "seq") -> DataFrame:
    """(pattern, count): most frequent character substitutions of failing pairs with Telugu on either side; ties by first appearance."""
    one = _failing(df).select(order, F.posexplode(text.substitutions(F.col("prediction"), F.col("telugu_text"))).alias("i", "x"))
    one = one.where(text.is_mostly(F.col("x.ref")) | text.is_mostly(F.col("x.pred")))
    counts = one.groupBy(F.concat("x.ref", F.lit("→"), "x.pred").alias("pattern")).agg(F.count(F.lit(1)).alias("count"), F.min(F.struct(order, "i")).alias("first"))
    return counts.orderBy(F.desc("count"), "first").limit(top).select("pattern", "count")


def worst(df: DataFrame, top: int = 20, order: str = "seq") -> DataFrame:
    """The failing pairs of the highest error, ties in input order."""
    return _failing(df).orderBy(F.desc("cer"), order).limit(top).select(order, "roman_text", F.col("telugu_text").alias("ref"), "prediction", "cer", "source_name", "pair_source")


def compare(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """(slice, baseline_cer, new_cer, delta, pct, status) for the slices of either side; status is null (not applicable) where a rate is missing."""
    b, c = (d.select("slice", F.col("cer").alias(n)) for d, n in ((baseline, "baseline_cer"), (candidate, "new_cer")))
    delta = F.col("new_cer") - F.col("baseline_cer")
    out = b.join(c, "slice", "full_outer").withColumn("delta", delta)
    pct = F.when(F.col("baseline_cer") > 0, F.col("delta") / F.col("baseline_cer") * 100).when(F.col("delta").isNotNull(), 0.0)
    status = F.when(F.col("delta") < -0.002, "BETTER").when(F.col("delta") > 0.002, "WORSE").when(F.col("delta").isNotNull(), "same")
    return out.withColumn("pct", pct).withColumn("status", status)


def acceptance(slices: DataFrame, targets: tuple[tuple[str, float], ...] = TARGETS) -> DataFrame:
    """(slice, cer, cer_max, met): acceptance targets, met when the error is under the target; a slice without rate has a null."""
    want = slices.sparkSession.createDataFrame(list(targets), "slice string, cer_max double")
    return F.broadcast(want).join(slices.select("slice", "cer"), "slice", "left").withColumn("met", F.col("cer") < F.col("cer_max"))


def divergent(df: DataFrame, a: str, b: str, top: int = 10, order: str = "seq") -> DataFrame:
    """Rows on which two predictions differ most in error, ties by the later row; rows without the second are left out."""
    e = df.where(F.col(b).isNotNull()).withColumns({f"{x}_cer": text.cer(F.col(x), F.col("telugu_text"), True) for x in (a, b)})
    return e.withColumn("gap", F.abs(F.col(f"{a}_cer") - F.col(f"{b}_cer"))).orderBy(F.desc("gap"), F.desc(order)).limit(top)


def sample(df: DataFrame, n: int, seed: int = 42, order: str = "seq") -> DataFrame:
    """``n`` rows, the same for the same seed: the smallest hashes of seed and identifier."""
    return df.orderBy(text.draw(order, seed), order).limit(n)


def card_metrics(slices: DataFrame) -> DataFrame:
    """(slice, n, cer_text, wer_text): metrics as a card prints them; a missing rate is a dash."""
    pct = lambda c: F.coalesce(F.concat(F.replace(F.format_number(F.col(c) * 100, 2), F.lit(","), F.lit("")), F.lit("%")), F.lit("—"))
    return slices.select("slice", F.coalesce("count", F.lit(0)).alias("n"), pct("cer").alias("cer_text"), pct("wer").alias("wer_text"))


def dataset_card(df: DataFrame, splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """(source_name, one column per split, total): pairs by source and split as a card prints them, with thousands separators; a last row, total, sums the sources. Null sources are unknown, other splits count in the total only."""
    source = F.coalesce("source_name", F.lit("unknown"))
    counts = [F.count_if(F.col("split") == s).alias(s) for s in splits] + [F.count(F.lit(1)).alias("total")]
    by = df.groupBy(source.alias("source_name")).agg(*counts)
    whole = by.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*splits, "total")]).select(F.lit("total").alias("source_name"), *splits, "total")
    return by.unionByName(whole).select("source_name", *[F.format_number(c, 0).alias(c) for c in (*splits, "total")])
