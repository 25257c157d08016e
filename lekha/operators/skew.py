"""Joins and aggregations that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than 1/HOT_PARTS of the rows; so at most HOT_PARTS keys are hot.
HOT_PARTS = 1000


def hot_bound(total: int, parts: int = HOT_PARTS) -> int:
    """Row count above which a key is hot, at every size of table. At most ``parts`` keys can exceed it, which bounds every broadcast of hot keys."""
    return max(1, total // parts)


def join_group_values(rows: DataFrame, groups: DataFrame, keys: list[str], size_col: str, total: int, how: str = "inner") -> DataFrame:
    """Join per-group values to rows without sending a hot group through one task.

    ``groups`` has one row per key and its number of rows in ``size_col``. Groups above
    :func:`hot_bound` (at most ``HOT_PARTS`` of them) are broadcast; the other rows take a
    shuffled join on evenly sized keys. Null keys never match; with ``how='left'`` they are kept.
    """
    bound = hot_bound(total)
    hot, cold = groups.where(F.col(size_col) > bound), groups.where(F.col(size_col) <= bound)
    hot_keys = F.broadcast(hot.select(*keys))
    out = rows.join(F.broadcast(hot), keys, "inner")
    return out.unionByName(rows.join(hot_keys, keys, "left_anti").join(cold, keys, how))


def two_level_counts(rows: DataFrame, keys: list[str], id_col: str, total: int, salts: int = 64) -> DataFrame:
    """(keys, n, first_id): copies and smallest identifier of each key.

    Exact counts, combined on the map side, name the hot keys (at most ``HOT_PARTS``). Their
    rows are salted and aggregated in two levels; all other keys take one shuffle.
    """
    bound = hot_bound(total)
    level = [F.count(F.lit(1)).alias("n"), F.min(id_col).alias("first_id")]
    hot = F.broadcast(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bound).select(*keys))
    salted = rows.join(hot, keys, "left_semi").withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salts)))
    first = salted.groupBy(*keys, "_salt").agg(*level)
    second = first.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"))
    return rows.join(hot, keys, "left_anti").groupBy(*keys).agg(*level).unionByName(second)


def _merged(keys: np.ndarray, counts: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Counters of distinct keys, at most ``room`` of them (Misra-Gries: the largest that is left out is taken off all)."""
    unique, at = np.unique(keys, return_inverse=True)
    total = np.bincount(at, counts, len(unique)).astype(np.int64)
    if len(unique) > room:
        least = np.partition(total, len(total) - room - 1)[len(total) - room - 1]
        total -= least
        keep = total > 0
        unique, total = unique[keep], total[keep]
    return unique, total


def heavy_hashes(df: DataFrame, key: Column, parts: int = HOT_PARTS) -> list[int]:
    """Every value of the bigint ``key`` that holds more than 1/``parts`` of the rows (and some from three quarters of that on); at most 4/3 ``parts`` values.

    Each partition keeps 4 ``parts`` Misra-Gries counters, so only those are shuffled, not the
    keys, and only the values found reach the driver. A counter is too low by a quarter of the
    threshold at most, hence the three quarters.
    """
    room = 4 * parts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, n = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for b in batches:
            got = b.column(0).drop_null().to_numpy(zero_copy_only=False)
            n += len(got)
            keys, counts = _merged(np.concatenate([keys, got]), np.concatenate([counts, np.ones(len(got), np.int64)]), room)
        yield pa.RecordBatch.from_arrays([pa.array([None, *keys.tolist()], pa.int64()), pa.array([n, *counts.tolist()], pa.int64())], names=["h", "est"])

    found = df.select(key.alias("h")).mapInArrow(count, "h bigint, est bigint").groupBy("h").agg(F.sum("est").alias("est"))
    top = found.orderBy(F.desc("est"), F.asc_nulls_first("h")).limit(parts * 4 // 3 + 2).collect()  # the null holds the number of rows
    total = sum(r.est for r in top if r.h is None)
    return [r.h for r in top if r.h is not None and r.est > max(1, 0.75 * total / parts)]


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], salts: int = 32, parts: int = HOT_PARTS) -> DataFrame:
    """Inner join on ``keys``, balanced when keys are hot on either side or on both.

    A key that holds more than 1/``parts`` of a side's rows (:func:`heavy_hashes`, a bounded
    list) is split: the side's rows go to ``salts`` parts and the other side's rows are
    repeated for each; a key that is hot on both sides makes a grid of about as many cells.
    The salt is a hash of the row: a task that runs again sends it to the same part. Without
    hot keys it is a plain join. Both sides are read twice, so they should be tables.
    """
    h = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    hot_l, hot_r = (set(heavy_hashes(d, h, parts)) for d in (left, right))
    if not hot_l | hot_r:
        return left.join(right, keys)
    side = max(1, round(salts**0.5))
    cells = lambda k, mine, other: side if k in mine and k in other else salts if k in mine else 1
    hot = F.broadcast(left.sparkSession.createDataFrame([(k, cells(k, hot_l, hot_r), cells(k, hot_r, hot_l)) for k in sorted(hot_l | hot_r)], "_h bigint, _sl int, _sr int"))
    one = lambda c: F.coalesce(F.col(c), F.lit(1))

    def spread(d: DataFrame, own: str, other: str, x: str, y: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in d.columns]), one(own).cast("bigint")).cast("int")
        out = d.withColumn("_h", h).join(hot, "_h", "left")
        return out.withColumn(x, mine).withColumn(y, F.explode(F.sequence(F.lit(0), one(other) - 1))).drop("_h", "_sl", "_sr")

    return spread(left, "_sl", "_sr", "_x", "_y").join(spread(right, "_sr", "_sl", "_y", "_x"), [*keys, "_x", "_y"]).drop("_x", "_y")
