"""The curation pipeline as one chain of stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lekha.config import NearDup
from lekha.functions.text import draw
from lekha.operators import curate
from lekha.session import materialize


def made_pairs(raw: DataFrame, created_at: str = "") -> DataFrame:
    """Raw records to pairs before duplicates are removed, with ``seq`` in the order of the records.

    A pair stands where its records stand (``seq`` of the raw rows), its clauses follow in
    their order, and variants follow their original, so "first" never depends on identifiers
    or on how the data are partitioned.
    """
    pairs = raw.transform(curate.normalized_rows).transform(curate.clean_rows).transform(lambda d: curate.build_pairs(d, created_at))
    made = pairs.transform(curate.fill_pending).transform(curate.improve_pairs).transform(curate.augment)
    # numbered along a range-partitioned sort; the snapshot parts builders that count alike
    return materialize(made.orderBy(curate.ORDER, curate.SNAPSHOT, "pair_source").withColumn("seq", F.monotonically_increasing_id()), "pairs")


def curated_pairs(raw: DataFrame, created_at: str = "", near: NearDup | None = NearDup(), per_snapshot: bool = True) -> DataFrame:
    """Raw records to scored pairs: normalise, filter, build pairs, romanise, improve, augment, deduplicate, score.

    Duplicates are removed within each snapshot (``per_snapshot``) or over all of them, the
    first in the order of :func:`made_pairs` stays. Without ``near`` only exact copies go.
    """
    by = [curate.SNAPSHOT] if per_snapshot else []
    once = curate.exact_dedup(made_pairs(raw, created_at), by=by)
    if near is not None:
        once = curate.near_dedup(materialize(once, "once"), near=near, by=by)
    return curate.score(once)


def union_sources(*frames: DataFrame | None) -> DataFrame:
    """Rows of all given sources; missing ones are skipped, missing columns are null."""
    first, *rest = [f for f in frames if f is not None]
    for f in rest:
        first = first.unionByName(f, allowMissingColumns=True)
    return first


def scored_else_deduped(scored: list[DataFrame], deduped: list[DataFrame]) -> DataFrame:
    """All scored sources if there is any, else the deduplicated ones."""
    return union_sources(*(scored or deduped))


def shuffled(df: DataFrame, seed: int = 42, order: str = "seq") -> DataFrame:
    """Rows in an order that only depends on the seed."""
    return df.orderBy(draw(order, seed), order)


def dataset(scored: DataFrame) -> DataFrame:
    """Approved pairs with their split."""
    return scored.transform(curate.split)


def route_counts(scored: DataFrame) -> DataFrame:
    """(route, n)."""
    return scored.groupBy(curate.route(scored).alias("route")).agg(F.count(F.lit(1)).alias("n"))
