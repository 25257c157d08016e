"""MinHash bands of character shingles, vectorised over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_MIX = np.uint64(0x9E3779B97F4A7C15)


def band_keys(texts: list[str], shingle: int, permutations: int, bands: int, seed: int = 1) -> np.ndarray:
    """A line of ``bands`` keys for each text; texts have ``shingle`` code points or more.

    A permutation is a seeded odd multiply-add of the shingle hash; a band is the hash of its
    permutations' minima, so equal sets of shingles have equal keys.
    """
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = np.array([len(t) for t in texts], np.int64)
    count = n - shingle + 1
    first = np.cumsum(count) - count
    at = np.arange(count.sum()) - np.repeat(first, count) + np.repeat(np.cumsum(n) - n, count)
    gram = np.zeros(len(at), np.uint64)
    for i in range(shingle):
        gram = (gram ^ code[at + i]) * _MIX
        gram ^= gram >> np.uint64(32)
    draw = np.random.default_rng(seed)
    keys = np.zeros((len(texts), bands), np.uint64)
    for p in range(permutations):
        a, b = (np.uint64(x) for x in draw.integers(0, 2**63, 2, dtype=np.int64))
        x = gram * (a * np.uint64(2) + np.uint64(1)) + b
        x ^= x >> np.uint64(31)
        least = np.minimum.reduceat(x * _MIX, first)
        k = p * bands // permutations
        keys[:, k] = (keys[:, k] ^ least) * _MIX + np.uint64(k)
    return keys.view(np.int64)


def with_bands(df: DataFrame, id_col: str, text: str, shingle: int, permutations: int, bands: int) -> DataFrame:
    """(id, band, key): the band keys of each text; shorter texts have none."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            long = [i for i, t in enumerate(texts) if t is not None and len(t) >= shingle]
            if long:
                keys = band_keys([texts[i] for i in long], shingle, permutations, bands)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.repeat(long, bands))), pa.array(np.tile(np.arange(bands, dtype=np.int32), len(long))), pa.array(keys.reshape(-1))], names=[id_col, "band", "key"])

    return df.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, band int, key bigint")
