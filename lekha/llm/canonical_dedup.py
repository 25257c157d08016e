"""Duplicates hidden by formatting: one row per record with its number of copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lekha.llm.pairkeys import pair_keys
from lekha.operators.skew import join_group_values, two_level_counts
from lekha.session import materialize

_KEY = ["rec1", "rec2"]


def _counted(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame, int]:
    keyed = materialize(pair_keys(df, want=_KEY, keep=[], id_col=id_col), "p2keys")
    total = keyed.count()
    return keyed, two_level_counts(keyed, _KEY, id_col, total), total


def records(df: DataFrame, id_col: str = "seq") -> DataFrame:
    """(keep_seq, copies): one row per record, the smallest identifier and the number of rows.

    Rows are one record when both sides agree apart from layout, case, punctuation,
    canonically equivalent encodings and an exchange of the two columns. Null equals empty,
    so all rows without readable text form one record. Hot keys are salted
    (:func:`two_level_counts`). An empty table gives no rows.
    """
    _, counts, _ = _counted(df, id_col)
    return counts.select(F.col("first_id").alias("keep_seq"), F.col("n").alias("copies"))


def copies(df: DataFrame, id_col: str = "seq") -> DataFrame:
    """(keep_seq, copy_seq): every row but the first of its record, with the first's identifier."""
    keyed, counts, total = _counted(df, id_col)
    repeated = materialize(counts.where("n > 1"), "p2repeated")
    members = join_group_values(keyed, repeated, _KEY, "n", total)
    return members.where(F.col(id_col) != F.col("first_id")).select(F.col("first_id").alias("keep_seq"), F.col(id_col).alias("copy_seq"))
