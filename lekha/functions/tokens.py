"""Byte-level model inputs as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Identifiers of the public byte-level scheme (a byte is its value plus FIRST), and the label that a loss leaves out.
PAD, END, FIRST, IGNORED = 0, 1, 3, -100


def byte_ids(c: Column, length: int = 128) -> Column:
    """array<int> of the UTF-8 bytes of a text and an end mark, cut to ``length`` identifiers with the end mark kept; null counts as empty."""
    coded = F.substring(F.hex(F.encode(F.coalesce(c, F.lit("")), "UTF-8")), 1, 2 * (length - 1))
    ids = F.transform(F.regexp_extract_all(coded, F.lit("(..)"), 1), lambda x: F.conv(x, 16, 10).cast("int") + FIRST)
    return F.array_append(ids, F.lit(END))


def _filled(ids: Column, length: int, value: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(value), F.lit(length) - F.size(ids)))


def encoded(df: DataFrame, input_field: str = "roman_text", target_field: str = "telugu_text", input_length: int = 128, target_length: int = 128) -> DataFrame:
    """Adds input_ids, attention_mask and labels of fixed lengths for training, and whether either text was cut. The reverse direction swaps the fields."""
    out = df.withColumns({"input_ids": byte_ids(F.col(input_field), input_length), "labels": byte_ids(F.col(target_field), target_length)})
    size = lambda c: F.octet_length(F.coalesce(F.col(c), F.lit("")))
    return out.withColumns({
        "attention_mask": _filled(F.transform("input_ids", lambda _: F.lit(1)), input_length, 0),
        "input_ids": _filled(F.col("input_ids"), input_length, PAD),
        "labels": _filled(F.col("labels"), target_length, IGNORED),
        "cut": (size(input_field) >= input_length) | (size(target_field) >= target_length),
    })
