"""Comparison keys of TranslitPair rows, made in one Arrow pass over the two text columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lekha.functions.canonical import key_pairs, telugu_first, words_of

#: column -> Spark type, in the order in which they are made
KEY_TYPES = {
    "te1": "bigint", "te2": "bigint",      # Telugu side, same apart from formatting
    "rec1": "bigint", "rec2": "bigint",    # both sides
    "doc1": "bigint", "doc2": "bigint",    # source and document; null when either is null
    "n_words": "int", "words": "string",   # words of the Telugu side; text only from `min_words` on
}


def pair_keys(df: DataFrame, *, want: list[str], keep: list[str], id_col: str = "seq", roman: str = "roman_text", telugu: str = "telugu_text", source: str = "source_name", doc: str = "doc_key", min_words: int = 1) -> DataFrame:
    """One row per input row: ``id_col``, the ``keep`` columns and the wanted keys (:data:`KEY_TYPES`).

    Null and empty texts count as the same, empty text. Only the columns that are needed are read.
    """
    inputs = list(dict.fromkeys([id_col, *keep, telugu, roman, *([source, doc] if "doc1" in want else [])]))
    narrow = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(inputs)])
    at = {c: f"c{i}" for i, c in enumerate(inputs)}
    kinds = {c: df.schema[c].dataType.simpleString() for c in [id_col, *keep]}
    schema = ", ".join([*(f"`{c}` {k}" for c, k in kinds.items()), *(f"{c} {KEY_TYPES[c]}" for c in want)])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = {c: b.column(b.schema.get_field_index(a)) for c, a in at.items()}
            te, ro = telugu_first(col[roman].to_pylist(), col[telugu].to_pylist())
            te_words = words_of(te)
            made: dict[str, pa.Array] = {}
            bare = [w.replace(" ", "") for w in te_words]
            if "te1" in want:
                keys = key_pairs(bare)
                made["te1"], made["te2"] = pa.array(keys[:, 0]), pa.array(keys[:, 1])
            if "rec1" in want:
                keys = key_pairs(a + "\x1e" + w.replace(" ", "") for a, w in zip(bare, words_of(ro)))
                made["rec1"], made["rec2"] = pa.array(keys[:, 0]), pa.array(keys[:, 1])
            if "doc1" in want:
                pairs = list(zip(col[source].to_pylist(), col[doc].to_pylist()))
                none = np.array([s is None or d is None for s, d in pairs], dtype=bool)
                keys = key_pairs("" if s is None or d is None else s.strip().lower() + "\x1e" + d for s, d in pairs)
                made["doc1"], made["doc2"] = pa.array(keys[:, 0], mask=none), pa.array(keys[:, 1], mask=none)
            if "n_words" in want:
                n = [w.count(" ") + 1 if w else 0 for w in te_words]
                made["n_words"] = pa.array(n, pa.int32())
                if "words" in want:
                    made["words"] = pa.array([w if k >= min_words else None for w, k in zip(te_words, n)], pa.string())
            yield pa.RecordBatch.from_arrays([*(col[c] for c in kinds), *(made[c] for c in want)], names=[*kinds, *want])

    return narrow.mapInArrow(keyed, schema)
