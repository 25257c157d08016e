"""Mixing sources to target shares by weighted sampling without replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lekha.llm.cutoff import source_key
from lekha.session import materialize

#: Weight of a row without score, and the least and largest weight of any row.
MISSING_WEIGHT, LEAST_WEIGHT, MOST_WEIGHT = 0.5, 0.01, 1e9
#: Sampling keys are counted in steps of this many to a factor of e, and the step that the budget ends in again in this many finer ones.
STEPS, FINER = 16, 4096
#: Targets of more parts are joined by a shuffle.
PLAN_LIMIT = 100_000


def _budgets(parts: dict[int, dict], budget: float) -> None:
    """Give each part its target of the budget; what a part cannot hold goes to the others in proportion to their targets."""
    open_parts = {k for k, p in parts.items() if p["share"] > 0}
    left = budget
    for p in parts.values():
        p["budget"] = 0.0
    while open_parts and left > 1e-9:
        unit = left / sum(parts[k]["share"] for k in open_parts)
        full = {k for k in open_parts if parts[k]["room"] <= parts[k]["share"] * unit}
        for k in full or open_parts:
            parts[k]["budget"] = parts[k]["room"] if full else parts[k]["share"] * unit
            left -= parts[k]["budget"]
        if not full:
            break
        open_parts -= full


def _budget_plan(parts: list[dict], budget: float, whole: bool) -> list[dict]:
    """Adds budget, epochs and rest (what is drawn after the complete epochs) to parts with share, cap and size."""
    by = dict(enumerate(parts))
    for p in parts:
        p["room"] = float(p["size"] * p["cap"])
    _budgets(by, budget)
    if whole:  # whole rows: the largest fractions get the rows that rounding down leaves
        exact = {i: p["budget"] for i, p in by.items()}
        for p in parts:
            p["budget"] = float(int(p["budget"] + 1e-6))
        spare = int(round(sum(exact.values()))) - int(sum(p["budget"] for p in parts))
        for i in sorted(by, key=lambda i: (by[i]["budget"] - exact[i], i))[: max(0, spare)]:
            by[i]["budget"] = min(by[i]["budget"] + 1, by[i]["room"])
    for p in parts:
        p["epochs"] = int((p["budget"] + 1e-6) // p["size"]) if p["size"] else 0
        p["rest"] = p["budget"] - p["epochs"] * p["size"] if p["epochs"] < p["cap"] else 0.0
    return parts


def _ends(amounts: DataFrame, step: str, rest: str) -> DataFrame:
    """(part, end, before): the first step whose running sum exceeds the rest, and the sum before it; none for parts that end in no step. A row per step, so the window is small."""
    cum = F.sum("amount").over(Window.partitionBy("part").orderBy(step).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return amounts.withColumn("_cum", cum).where(F.col("_cum") > F.col(rest) + 1e-6).groupBy("part").agg(F.min(F.struct(F.col(step).alias("end"), (F.col("_cum") - F.col("amount")).alias("before"))).alias("e")).select("part", "e.*")


def mixture(df: DataFrame, targets: DataFrame, *, id_col: str = "seq", source: str = "source_name", part: str = "pair_source", size: str | None = None, weight: str = "quality_score", budget: float | None = None, seed: int = 0) -> DataFrame:
    """(seq, source_name, pair_source, uses): the rows of the mixture and how often each is used.

    The budget (default: the size of the table) is divided by ``target_share``. A part is
    used in complete epochs first; the rest of its budget is drawn without replacement by
    Efraimidis-Spirakis keys -ln(u)/weight, smallest first, up to the last row that fits.
    No row is used more than ``max_repeats`` times; what a part cannot give is divided among
    the others by their targets. The key order is cut by exact prefix sums in three levels:
    amounts per step of the key's logarithm, amounts per finer step of the one step in which
    the budget ends, and a sort of the rows of one finer step, about 1/60,000 of a part at
    any weights. ``size`` names a column to measure by (rows otherwise). Null and NaN weights
    count as MISSING_WEIGHT, weights outside LEAST_WEIGHT and MOST_WEIGHT as these. Rows of
    null source or part, or of no target, are not used. Equal seeds give equal mixtures;
    identifiers must be unique. ``targets`` is a configuration table with a row per part,
    which the driver reads; its plan is broadcast while it has no more than PLAN_LIMIT parts.
    """
    spark = df.sparkSession
    want = targets.select(source_key(F.col(source)).alias("_s"), F.col(part).alias("_p"), F.col("target_share").cast("double").alias("share"), F.col("max_repeats").cast("bigint").alias("cap"))
    want = want.where("_s is not null and _p is not null").groupBy("_s", "_p").agg(F.sum("share").alias("share"), F.max("cap").alias("cap")).collect()
    parts = [{"part": i, "source_name": r._s, "pair_source": r._p, "share": max(0.0, r.share) if r.share is not None and r.share == r.share else 0.0, "cap": max(0, r.cap or 0)} for i, r in enumerate(sorted(want))]
    small = F.broadcast if len(parts) <= PLAN_LIMIT else lambda d: d
    named = spark.createDataFrame([(p["part"], p["source_name"], p["pair_source"]) for p in parts], "part int, _s string, _p string")
    w = F.when(F.col(weight).isNull() | F.isnan(weight), MISSING_WEIGHT).otherwise(F.least(F.greatest(F.col(weight).cast("double"), F.lit(LEAST_WEIGHT)), F.lit(MOST_WEIGHT)))
    amount = F.greatest(F.coalesce(F.col(size).cast("bigint"), F.lit(0)), F.lit(0)) if size else F.lit(1).cast("bigint")
    u = (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col(id_col))), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    rows = df.select(F.col(id_col).alias("id"), source_key(F.col(source)).alias("_s"), F.col(part).alias("_p"), (-F.ln(u) / w).alias("key"), amount.alias("amount"))
    rows = rows.join(small(named), ["_s", "_p"], "left").select("id", "part", "key", "amount").withColumn("at", F.ln("key") * STEPS).withColumn("step", F.floor("at").cast("int"))
    steps = materialize(rows.groupBy("part", "step").agg(F.sum("amount").alias("amount")), "p3steps")  # a few hundred steps a part
    sizes = {r.part: r.a for r in steps.groupBy("part").agg(F.sum("amount").alias("a")).collect()}
    parts = _budget_plan([p | {"size": sizes.get(p["part"], 0)} for p in parts], float(sum(sizes.values())) if budget is None else budget, not size)
    plan = spark.createDataFrame([(p["part"], p["source_name"], p["pair_source"], p["epochs"], float(p["rest"])) for p in parts], "part int, source_name string, pair_source string, epochs bigint, rest double")
    ends = materialize(_ends(steps.join(small(plan), "part"), "step", "rest"), "p3ends")
    edge = rows.join(small(ends.select("part", F.col("end").alias("step"), "before")), ["part", "step"]).join(small(plan.select("part", "rest")), "part")
    edge = materialize(edge.select("part", "id", "key", "amount", F.least(F.lit(FINER - 1), F.floor((F.col("at") - F.col("step")) * FINER)).cast("int").alias("fine"), (F.col("rest") - F.col("before")).alias("left")), "p3edge")
    fine = _ends(edge.groupBy("part", "fine", "left").agg(F.sum("amount").alias("amount")), "fine", "left")
    last = edge.join(small(fine.select("part", F.col("end").alias("fine"), "before")), ["part", "fine"])
    run = F.sum("amount").over(Window.partitionBy("part").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = last.withColumn("fits", F.col("before") + run <= F.col("left") + 1e-6).groupBy("part", "fine").agg(F.max(F.when(F.col("fits"), F.struct("key", "id"))).alias("cut"))
    cuts = materialize(ends.select("part", F.col("end").alias("_step")).join(last.select("part", F.col("fine").alias("_fine"), "cut"), "part"), "p3cuts")
    placed = rows.join(small(plan), "part").join(small(cuts), "part", "left")
    finer = F.least(F.lit(FINER - 1), F.floor((F.col("at") - F.col("step")) * FINER))
    drawn = F.col("_step").isNull() | (F.col("step") < F.col("_step")) | ((F.col("step") == F.col("_step")) & ((finer < F.col("_fine")) | ((finer == F.col("_fine")) & F.coalesce(F.struct("key", "id") <= F.col("cut"), F.lit(False)))))
    return placed.select(F.col("id").alias(id_col), "source_name", "pair_source", (F.col("epochs") + F.when((F.col("rest") > 0) & drawn, 1).otherwise(0)).alias("uses")).where("uses > 0")


def shares(df: DataFrame, targets: DataFrame, *, size: str | None = None, id_col: str = "seq", **options) -> DataFrame:
    """(source_name, pair_source, target_share, max_repeats, rows_available, rows_distinct, uses, most_uses, share): what the mixture reached for each target; shares are of the mixture."""
    mixed = mixture(df, targets, size=size, id_col=id_col, **options)
    if size:
        mixed = mixed.join(df.select(id_col, F.col(size).cast("bigint").alias("_amount")), id_col)
    amount = F.col("uses") * (F.coalesce("_amount", F.lit(0)) if size else F.lit(1))
    mixed = materialize(mixed.groupBy("source_name", "pair_source").agg(F.count(F.lit(1)).alias("rows_distinct"), F.sum("uses").alias("uses"), F.max("uses").alias("most_uses"), F.sum(amount).alias("_got")), "p3shares")
    source, part = options.get("source", "source_name"), options.get("part", "pair_source")
    have = df.groupBy(source_key(F.col(source)).alias("source_name"), F.col(part).alias("pair_source")).agg(F.count(F.lit(1)).alias("rows_available"))
    want = targets.groupBy(source_key(F.col(source)).alias("source_name"), F.col(part).alias("pair_source")).agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    out = want.join(F.broadcast(mixed), ["source_name", "pair_source"], "left").join(F.broadcast(have.join(F.broadcast(want.select("source_name", "pair_source")), ["source_name", "pair_source"], "left_semi")), ["source_name", "pair_source"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("source_name", "pair_source", "target_share", "max_repeats", zero("rows_available"), zero("rows_distinct"), zero("uses"), zero("most_uses"), F.coalesce(F.col("_got") / F.sum("_got").over(Window.partitionBy(F.lit(1))), F.lit(0.0)).alias("share"))
