"""Same or near-same records across splits.

Minwise hash shingles with banded buckets. Near-same means at most one word edit for every
``EDIT_EVERY`` words, so a shingle is a word with its number of occurrence: N words and
N/5 edits leave a Jaccard similarity of 2/3 at least. A text has BANDS bands of ROWS minwise
values, whatever its length; two texts that are just near-same share a band with probability
1 - (1 - (2/3)^ROWS)^BANDS = 0.9965, closer ones almost surely. Only buckets that hold train
and held-out texts give candidates, each across splits. A bucket of more than BUCKET_PAIRS
such pairs, or of more than 1/HOT_PARTS of the texts, is banded again by an independent signature.
Candidates are bounded by their exact Jaccard similarity and confirmed by the edit distance of their words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lekha.llm.pairkeys import pair_keys
from lekha.operators.skew import HOT_PARTS, heavy_hashes, join_group_values, salted_join
from lekha.session import discard, materialize

#: Two texts of at least MIN_WORDS words are near-same within one edit for each EDIT_EVERY words of the longer.
MIN_WORDS, EDIT_EVERY = 6, 5
#: Minwise values of a band and bands of a text; the same of the second signature, for the texts of large buckets.
ROWS, BANDS, AGAIN_ROWS, AGAIN_BANDS = 5, 40, 6, 64
#: A bucket of more candidate pairs is banded again.
BUCKET_PAIRS = 100_000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def signature(texts: list[str], rows: int = ROWS, bands: int = BANDS, seed: int = 1) -> np.ndarray:
    """Band keys (a line for each text, a column for each band) of canonical words; texts are not empty."""
    n = np.array([t.count(" ") + 1 for t in texts], np.int64)
    codes, unique = pd.factorize(np.array(" ".join(texts).split(" "), dtype=object))
    h = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in unique), np.uint64, len(unique))[codes]
    first = np.cumsum(n) - n
    text = np.repeat(np.arange(len(texts)), n)
    order = np.lexsort((codes, text))
    fresh = np.r_[True, (text[order][1:] != text[order][:-1]) | (codes[order][1:] != codes[order][:-1])]
    nth = np.empty(len(codes), np.int64)
    nth[order] = np.arange(len(codes)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    word = _mixed(h + nth.astype(np.uint64) * _M1)
    draw = np.random.default_rng(seed)
    out = np.empty((len(texts), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(texts), band + 1, np.uint64)
        for _ in range(rows):
            a, b = (np.uint64(x) for x in draw.integers(0, 2**63, 2, dtype=np.int64))
            x = word * (a * np.uint64(2) + np.uint64(1)) + b
            x ^= x >> np.uint64(31)
            key = _mixed((key ^ np.minimum.reduceat(x * _M1, first)) * _M1)
        out[:, band] = key
    return out.view(np.int64)


def _signed(texts: DataFrame, rows: int, bands: int, seed: int) -> DataFrame:
    """(wid, n, tr, ev, bands): the signature of each text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                words = b.column(3).to_pylist()
                keys = signature(words, rows, bands, seed)
                n = pa.array([w.count(" ") + 1 for w in words], pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1, dtype=np.int32) * bands), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays([b.column(0), n, b.column(1), b.column(2), lists], names=["wid", "n", "tr", "ev", "bands"])

    return texts.select("wid", "tr", "ev", "words").mapInArrow(sign, "wid bigint, n int, tr boolean, ev boolean, bands array<bigint>")


def _bucket_pairs(band: np.ndarray, wid: np.ndarray, n: np.ndarray, tr: np.ndarray, ev: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(train text, held-out text) of the buckets of at most ``most`` pairs, and the rows of larger buckets; rows are sorted by band."""
    group = np.cumsum(np.r_[False, band[1:] != band[:-1]])
    nt, ne = np.bincount(group, tr).astype(np.int64), np.bincount(group, ev).astype(np.int64)
    small, large = (nt * ne > 0) & (nt * ne <= most), nt * ne > most
    a, b = np.flatnonzero(tr & small[group]), np.flatnonzero(ev & small[group])
    count = nt[group[b]]
    held = np.repeat(b, count)
    train = a[np.repeat(np.searchsorted(group[a], group[b]), count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
    fit = (wid[held] != wid[train]) & (np.abs(n[held] - n[train]) <= np.maximum(n[held], n[train]) // EDIT_EVERY)
    pairs = np.unique(np.stack([wid[train][fit], wid[held][fit]], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1], np.flatnonzero(large[group])


def _meetings(rows: DataFrame, most: int) -> DataFrame:
    """(band, wa, wb): candidates (band is null), and the members of too large buckets (wa, with bit 1 of wb for train and bit 2 for held out).

    One shuffle by band; a task reads its buckets in order and holds one at a time, up to
    ``most`` rows of it, so no bucket is gathered whole.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        overfull: int | None = None  # the band whose first rows were already given as members

        def out(cols: list[np.ndarray]) -> pa.RecordBatch:
            band, wid, n, tr, ev = cols
            over = band == overfull if overfull is not None else np.zeros(len(band), bool)
            wa, wb, rest = _bucket_pairs(*(c[~over] for c in cols), most) if (~over).any() else (np.zeros(0, np.int64),) * 3
            many = np.r_[np.flatnonzero(over), np.flatnonzero(~over)[rest]]
            bands = pa.array(np.r_[np.zeros(len(wa), np.int64), band[many]], mask=np.r_[np.ones(len(wa), bool), np.zeros(len(many), bool)])
            return pa.RecordBatch.from_arrays([bands, pa.array(np.r_[wa, wid[many]]), pa.array(np.r_[wb, tr[many] + 2 * ev[many].astype(np.int64)])], names=["band", "wa", "wb"])

        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            cols = cols if held is None else [np.concatenate([x, y]) for x, y in zip(held, cols)]
            last = int(np.searchsorted(cols[0], cols[0][-1]))
            if last:
                yield out([c[:last] for c in cols])
            held = [c[last:] for c in cols]
            if len(held[0]) > most or held[0][0] == overfull:
                overfull = int(held[0][0])
                yield out(held)
                held = None
        if held is not None and len(held[0]):
            yield out(held)

    return rows.select("band", "wid", "n", "tr", "ev").repartition("band").sortWithinPartitions("band").mapInArrow(meet, "band bigint, wa bigint, wb bigint")


def _again(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(wa, wb): candidates of the members (band, wid) of too large buckets, by a second signature within their bucket."""
    ids = members.select("wid").distinct()
    signed = materialize(_signed(texts.join(ids, "wid", "left_semi"), AGAIN_ROWS, AGAIN_BANDS, 2), "p1again")
    own = materialize(salted_join(members, signed, ["wid"]).select("wid", "n", "tr", "ev", F.explode(F.transform("bands", lambda k: F.xxhash64("band", k))).alias("sub")), "p1subbands")
    a = own.where("tr").select("sub", F.col("wid").alias("wa"), F.col("n").alias("na"))
    b = own.where("ev").select("sub", F.col("wid").alias("wb"), F.col("n").alias("nb"))
    return salted_join(a, b, ["sub"]).where((F.col("wa") != F.col("wb")) & (F.abs(F.col("na") - F.col("nb")) <= F.floor(F.greatest("na", "nb") / EDIT_EVERY))).select("wa", "wb")


def word_edits(a: list[str], b: list[str], most: int) -> int:
    """Word edit distance of two texts, or ``most`` + 1 when it is larger (banded)."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - most), min(len(b), i + most)
        last, row[lo - 1] = row[lo - 1], i if lo == 1 else most + 1
        for j in range(lo, hi + 1):
            last, row[j] = row[j], min(last + (x != b[j - 1]), (row[j] if j < i + most else most + 1) + 1, row[j - 1] + 1)
        if min(row[lo - 1 : hi + 1]) > most:
            return most + 1
    return min(row[-1], most + 1)


def jaccard(a: list[str], b: list[str]) -> float:
    """Exact Jaccard similarity of two texts' words, repeated words counted."""
    x, y = Counter(a), Counter(b)
    both = sum((x & y).values())
    return both / (len(a) + len(b) - both)


def _confirm(cands: DataFrame) -> DataFrame:
    """Exact check of (wa, wb, words_a, words_b): Jaccard similarity as a bound, then word edits."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good, similar, edits = [], [], []
            for i, (x, y) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                p, q = x.split(" "), y.split(" ")
                longer, shorter = max(len(p), len(q)), min(len(p), len(q))
                most = longer // EDIT_EVERY
                j = jaccard(p, q)
                if j * (shorter + most) < longer - most - 1e-9:  # fewer common words than the edits leave
                    continue
                if (e := word_edits(p, q, most)) <= most:
                    good.append(i)
                    similar.append(j)
                    edits.append(e)
            take = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(similar, pa.float64()), pa.array(edits, pa.int32())], names=["wa", "wb", "jaccard", "edits"])

    return cands.mapInArrow(check, "wa bigint, wb bigint, jaccard double, edits int")


def near_texts(base: DataFrame, bucket_pairs: int = BUCKET_PAIRS, hot_parts: int = HOT_PARTS) -> tuple[DataFrame, DataFrame]:
    """(texts, links): the distinct word sequences of ``base`` (te1, te2, words, seq, tr) and the near-same pairs of them that cross splits.

    texts: wid, words, te1, te2, tr, ev, n_tr, n_ev. links: wa (in train), wb (held out), jaccard, edits.
    Copies are one text, so no links between copies are made.
    """
    long = base.where(F.col("words").isNotNull())
    texts = materialize(long.groupBy("words").agg(F.min("seq").alias("wid"), F.max("tr").alias("tr"), F.max(~F.col("tr")).alias("ev"), F.count_if("tr").alias("n_tr"), F.count_if(~F.col("tr")).alias("n_ev"), F.first("te1").alias("te1"), F.first("te2").alias("te2")), "p1texts")
    signed = materialize(_signed(texts, ROWS, BANDS, 1), "p1bands")
    rows = signed.select(F.explode("bands").alias("band"), "wid", "n", "tr", "ev")
    hot = heavy_hashes(rows, F.col("band"), hot_parts)
    met = materialize(_meetings(rows.where(~F.col("band").isin(hot)) if hot else rows, bucket_pairs), "p1met")
    pairs = met.where("band is null").select("wa", "wb")
    members = met.where("band is not null").select("band", F.col("wa").alias("wid"))
    if hot:
        members = members.unionByName(rows.where(F.col("band").isin(hot)).select("band", "wid"))
    members = materialize(members, "p1large")
    if not members.isEmpty():
        pairs = pairs.unionByName(_again(members, texts))
    pairs = materialize(pairs.distinct(), "p1pairs")
    discard(signed, met)
    words = texts.select("wid", "words", "te1", "te2")
    x = words.select(F.col("wid").alias("wa"), F.col("words").alias("words_a"), F.col("te1").alias("a1"), F.col("te2").alias("a2"))
    y = words.select(F.col("wid").alias("wb"), F.col("words").alias("words_b"), F.col("te1").alias("b1"), F.col("te2").alias("b2"))
    with_a = materialize(salted_join(pairs, x, ["wa"]), "p1left")
    links = materialize(_confirm(salted_join(with_a, y, ["wb"]).where("a1 != b1 or a2 != b2").select("wa", "wb", "words_a", "words_b")), "p1links")
    discard(with_a, pairs)
    return texts, links


def _base(df: DataFrame, id_col: str, split: str, train: str, held_out: tuple[str, ...], source: str) -> tuple[DataFrame, DataFrame, int]:
    """Keyed rows, the classes of same Telugu sides that cross splits (te1, te2, n, n_tr), and the number of rows."""
    rows = df.where(F.col(split).isin(train, *held_out)).select(F.col(id_col).alias("seq"), "roman_text", "telugu_text", (F.col(split) == train).alias("tr"), F.col(split).alias("split"), F.col(source).alias("source"))
    base = materialize(pair_keys(rows, want=["te1", "te2", "n_words", "words"], keep=["tr", "split", "source"], min_words=MIN_WORDS), "p1base")
    classes = base.groupBy("te1", "te2").agg(F.count(F.lit(1)).alias("n"), F.count_if("tr").alias("n_tr"))
    return base, materialize(classes.where("n_tr > 0 and n_tr < n"), "p1cross"), base.count()


def pairs(df: DataFrame, *, id_col: str = "seq", split: str = "split", train: str = "train", held_out: tuple[str, ...] = ("val", "test"), source: str = "source_name", **limits) -> DataFrame:
    """(train_seq, held_seq, kind, jaccard, edits, split, source_name): every train row with every val or test row whose Telugu sides are the same apart from formatting or near-same.

    ``split`` and ``source_name`` are the held-out row's (source in lower case, trimmed).
    Rows of other or null splits are left out. Null equals empty text: rows without readable
    Telugu side are the same. Near-same texts have at least MIN_WORDS words each. Links are
    found between distinct texts and expanded to rows only here, as the result is defined by rows.
    ``limits`` are ``bucket_pairs`` and ``hot_parts`` of :func:`near_texts`; they change no result but for chance.
    """
    base, crossing, total = _base(df, id_col, split, train, held_out, source)
    members = materialize(join_group_values(base.select("seq", "tr", "split", "source", "te1", "te2"), crossing, ["te1", "te2"], "n", total), "p1members")
    a = members.where("tr").select(F.col("seq").alias("train_seq"), "te1", "te2")
    b = members.where("not tr").select(F.col("seq").alias("held_seq"), "split", "source", "te1", "te2")
    same = salted_join(a, b, ["te1", "te2"]).select("train_seq", "held_seq", F.lit("same").alias("kind"), F.lit(1.0).alias("jaccard"), F.lit(0).alias("edits"), "split", "source")

    texts, links = near_texts(base, **limits)
    linked = links.select(F.col("wa").alias("wid")).union(links.select(F.col("wb").alias("wid"))).distinct()
    of_text = materialize(texts.join(linked, "wid", "left_semi").select("wid", "words", (F.col("n_tr") + F.col("n_ev")).alias("n")), "p1oftext")
    rows = materialize(join_group_values(base.where("words is not null").select("seq", "tr", "split", "source", "words"), of_text, ["words"], "n", total).drop("words", "n"), "p1linked")
    a = rows.where("tr").select(F.col("seq").alias("train_seq"), F.col("wid").alias("wa"))
    b = rows.where("not tr").select(F.col("seq").alias("held_seq"), F.col("wid").alias("wb"), "split", "source")
    near = salted_join(b, materialize(salted_join(a, links, ["wa"]), "p1near"), ["wb"]).select("train_seq", "held_seq", F.lit("near").alias("kind"), "jaccard", "edits", "split", "source")
    return same.unionByName(near).withColumn("source_name", F.lower(F.trim("source"))).drop("source")


def found(df: DataFrame, **options) -> DataFrame:
    """(seq_a, seq_b) of :func:`pairs`, smaller first."""
    return pairs(df, **options).select(F.least("train_seq", "held_seq").alias("seq_a"), F.greatest("train_seq", "held_seq").alias("seq_b"))


def report(df: DataFrame, *, id_col: str = "seq", split: str = "split", train: str = "train", held_out: tuple[str, ...] = ("val", "test"), source: str = "source_name", **limits) -> DataFrame:
    """(split, source_name, same_pairs, near_pairs, held_rows): pairs of rows and leaked held-out rows per split and source of the held-out row.

    Counted from the classes and links of texts; no pair of rows is made.
    """
    base, crossing, total = _base(df, id_col, split, train, held_out, source)
    texts, links = near_texts(base, **limits)
    of_train = salted_join(links.select("wa", "wb"), texts.select(F.col("wid").alias("wa"), "n_tr"), ["wa"])
    near = of_train.groupBy(F.col("wb").alias("wid")).agg(F.sum("n_tr").alias("near")).join(texts.select("wid", "words", "n_ev"), "wid").select("words", "near", "n_ev")
    held = base.where("not tr").select("split", "source", "te1", "te2", "words")
    held = join_group_values(held, crossing.select("te1", "te2", "n", F.col("n_tr").alias("same")), ["te1", "te2"], "n", total, how="left")
    held = join_group_values(held, materialize(near, "p1nearrows"), ["words"], "n_ev", total, how="left").na.fill(0, ["same", "near"]).where("same + near > 0")
    return held.groupBy("split", F.lower(F.trim("source")).alias("source_name")).agg(F.sum("same").alias("same_pairs"), F.sum("near").alias("near_pairs"), F.count(F.lit(1)).alias("held_rows"))
