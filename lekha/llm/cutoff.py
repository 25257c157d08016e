"""Score cutoff per source that keeps a target share of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lekha.session import materialize

#: Rank error of the quantile sketch is at most 1/ACCURACY of the rows.
ACCURACY = 10_000
#: Targets of more sources are joined by a shuffle, and more different shares bracketed on a grid of this many steps.
PLAN_LIMIT = 100_000
GRID = 1000


def source_key(c: Column) -> Column:
    """Source names are compared without case and outer spaces; a blank name counts as none."""
    key = F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    return F.when(key != "", key)


def cutoffs(df: DataFrame, targets: DataFrame, *, score: str = "quality_score", source: str = "source_name", share: str = "keep_pct", accuracy: int = ACCURACY) -> DataFrame:
    """(source_name, keep_pct, cutoff, rows_scored, rows_kept) for each target.

    The cutoff is the largest score such that the rows at or above it are at least
    ``keep_pct`` percent of the source's rows with a score. Exact for every input: a quantile
    sketch brackets the target rank, one count checks the bracket (a source whose bracket
    fails gets an open one), and only the distinct scores inside the bracket are sorted.
    Null and NaN scores and null sources are left out; a target without scored rows has a
    null cutoff and 0 rows; ``keep_pct`` of 0 or less keeps none, 100 and more keeps all.
    Repeated targets of one source count once (the largest share). ``targets`` has one row
    per source name, a configuration table that is broadcast up to PLAN_LIMIT sources. The
    table is read three times: for the sketch, for the counts, and for the bracket.
    """
    want = targets.select(source_key(F.col(source)).alias("_src"), F.col(share).cast("double").alias("_pct")).where("_src is not null and _pct is not null").groupBy("_src").agg(F.max("_pct").alias("_pct"))
    want = materialize(want, "p5want")
    small = F.broadcast if want.count() <= PLAN_LIMIT else lambda d: d
    rows = df.select(source_key(F.col(source)).alias("_src"), F.col(score).cast("double").alias("_x")).where("_src is not null and _x is not null and not isnan(_x)")
    rows = rows.join(small(want), "_src")

    # the quantiles on both sides of each target, twice the sketch's error away
    clamp = lambda q: min(1.0, max(0.0, q))
    shares = [r._pct for r in want.select("_pct").distinct().limit(GRID + 1).collect()]
    around = {p: (clamp(1 - p / 100 - 2 / accuracy), clamp(1 - p / 100 + 2 / accuracy)) for p in shares}
    if len(shares) > GRID:
        points = [i / GRID for i in range(GRID + 1)]
        low, high = (F.least(F.lit(GRID), F.greatest(F.lit(0), f)).cast("int") + 1 for f in (F.floor((1 - F.col("_pct") / 100) * GRID) - 1, F.ceil((1 - F.col("_pct") / 100) * GRID) + 1))
    else:
        points = sorted({q for pair in around.values() for q in pair}) or [0.0]
        place = lambda k: F.element_at(F.create_map(*[F.lit(v) for p, pair in around.items() for v in (p, points.index(pair[k]) + 1)]), F.col("_pct")) if around else F.lit(1)
        low, high = place(0), place(1)
    sketch = rows.groupBy("_src", "_pct").agg(F.percentile_approx("_x", F.array([F.lit(q) for q in points]), F.lit(accuracy)).alias("_q"), F.count(F.lit(1)).alias("_n"))
    need = F.least(F.ceil(F.col("_pct") * F.col("_n") / 100), "_n")
    at = materialize(sketch.select("_src", "_n", need.alias("_need"), F.try_element_at("_q", low).alias("_lo"), F.try_element_at("_q", high).alias("_hi")), "p5sketch")

    counted = rows.join(small(at), "_src").groupBy("_src").agg(F.count_if(F.col("_x") > F.col("_hi")).alias("_over"), F.count_if(F.col("_x") >= F.col("_lo")).alias("_from_lo"))
    holds = (F.col("_over") < F.col("_need")) & (F.col("_from_lo") >= F.col("_need"))
    inf = F.lit(float("inf"))
    bracket = at.join(counted, "_src").select("_src", "_n", "_need", F.when(holds, F.col("_lo")).otherwise(-inf).alias("_lo"), F.when(holds, F.col("_hi")).otherwise(inf).alias("_hi"), F.when(holds, F.col("_over")).otherwise(0).alias("_over"))
    bracket = materialize(bracket, "p5bracket")

    inside = rows.join(small(bracket), "_src").where("_x >= _lo and _x <= _hi").groupBy("_src", "_n", "_need", "_over", "_x").agg(F.count(F.lit(1)).alias("_c"))
    above = Window.partitionBy("_src").orderBy(F.desc("_x")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("_cum", F.col("_over") + F.sum("_c").over(above)).where("_cum >= _need and _need > 0")
    found = ranked.groupBy("_src").agg(F.max(F.struct("_x", "_cum", "_n")).alias("_f"))
    return want.join(found, "_src", "left").join(at.select("_src", F.col("_n").alias("_all")), "_src", "left").select(
        F.col("_src").alias("source_name"), F.col("_pct").alias("keep_pct"), F.col("_f._x").alias("cutoff"), F.coalesce("_all", F.lit(0)).alias("rows_scored"), F.coalesce("_f._cum", F.lit(0)).alias("rows_kept")
    )


def kept(df: DataFrame, targets: DataFrame, *, id_col: str = "seq", score: str = "quality_score", source: str = "source_name", **options) -> DataFrame:
    """(seq): rows at or above the cutoff of their source; all rows tied with it are kept."""
    cuts = materialize(cutoffs(df, targets, score=score, source=source, **options).where("cutoff is not null").select(F.col("source_name").alias("_src"), "cutoff"), "p5cuts")
    rows = df.select(F.col(id_col), source_key(F.col(source)).alias("_src"), F.col(score).cast("double").alias("_x"))
    return rows.join(F.broadcast(cuts) if cuts.count() <= PLAN_LIMIT else cuts, "_src").where("_x >= cutoff and not isnan(_x)").select(id_col)
