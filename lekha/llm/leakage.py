"""Evaluation passages inside training documents, found through an FM-index per training shard.

A shard (the documents of some Arrow batches) is written as one sequence of word numbers.
Words that no item has become a separator, and only runs long enough to hold a passage are
kept, which loses no occurrence. The index is the Burrows-Wheeler transform of the sequence
in a wavelet matrix, built once for all items; their phrases of ``least`` words are searched
backwards block by block, occurrences are located through sampled suffix positions, and
overlapping occurrences of one item are merged into spans, and spans of all items into the
character ranges to remove.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lekha.functions.canonical import words_of

#: Consecutive words that make a leak.
LEAST_WORDS = 8
#: Words per shard (after pruning), phrases searched at once in its index, and distance of sampled suffix positions.
SHARD_WORDS, BLOCK_WORDS, SAMPLE = 1_000_000, 200_000, 16
#: Words of items (some 40,000 items) for which the corpus is read once; their numbers are broadcast. More take further passes.
PASS_WORDS = 4_000_000

_WORD = regex.compile(r"[\p{L}\p{M}\p{N}](?:\p{Cf}*[\p{L}\p{M}\p{N}])*")


class FMIndex:
    """Full-text index of an integer sequence (values from 1 on); all searches are vectorised."""

    def __init__(self, seq: np.ndarray, sample: int = SAMPLE):
        text = np.append(seq, 0).astype(np.int64)  # 0 ends the sequence and sorts first
        self.n = n = len(text)
        sa = self._suffixes(text)
        bwt = text[sa - 1]
        self.bits = max(1, int(text.max()).bit_length())
        counts = np.bincount(text, minlength=(1 << self.bits) + 1)
        self.starts = np.cumsum(counts) - counts  # first row of each symbol
        self.bwt = bwt
        self.levels: list[tuple[np.ndarray, int]] = []
        level = bwt
        for b in range(self.bits - 1, -1, -1):
            one = ((level >> b) & 1).astype(bool)
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            self.levels.append((ones, int(n - ones[-1])))
            level = np.concatenate([level[~one], level[one]])
        at = np.flatnonzero(sa % sample == 0)
        self.sampled = np.full(n, -1, np.int64)
        self.sampled[at] = sa[at]

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling."""
        n = len(text)
        _, rank = np.unique(text, return_inverse=True)
        rank = rank.astype(np.int64)
        k = 1
        while True:
            second = np.zeros(n, np.int64)
            second[: n - k] = rank[k:] + 1 if k < n else 0
            key = rank * (n + 1) + second
            sa = np.argsort(key, kind="stable")
            ordered = key[sa]
            new = np.empty(n, np.int64)
            new[sa] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            rank = new
            k *= 2
            if rank[sa[-1]] == n - 1 or k >= n:
                return sa

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` in the transform before ``row``."""
        lo, hi = np.zeros_like(row), row.copy()
        for i, (ones, zeros) in enumerate(self.levels):
            bit = (symbol >> (self.bits - 1 - i)) & 1 == 1
            lo1, hi1 = ones[lo], ones[hi]
            lo, hi = np.where(bit, zeros + lo1, lo - lo1), np.where(bit, zeros + hi1, hi - hi1)
        return hi - lo

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Half-open row ranges of the suffixes that start with each phrase (one per line)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, j]
            known = c < (1 << self.bits)
            lo[live[~known]] = hi[live[~known]] = 0
            live, c = live[known], c[known]
            lo[live] = self.starts[c] + self.rank(c, lo[live])
            hi[live] = self.starts[c] + self.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to a sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        out = np.full(len(rows), -1, np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            have = self.sampled[rows[todo]] >= 0
            done = todo[have]
            out[done] = self.sampled[rows[done]] + steps[done]
            todo = todo[~have]
            c = self.bwt[rows[todo]]
            rows[todo] = self.starts[c] + self.rank(c, rows[todo])
            steps[todo] += 1
        return out


def merged_spans(doc: np.ndarray, item: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last): the occurrences with which each span begins and ends; overlapping or touching occurrences of an item in a document are one span."""
    order = np.lexsort((at, item, doc))
    d, i, a = doc[order], item[order], at[order]
    if not len(d):
        return order, order
    first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (a[1:] > a[:-1] + width)])
    return order[first], order[np.r_[first[1:], len(d)] - 1]


def word_places(text: str, n: int) -> np.ndarray:
    """Start and end, in code points, of each of the ``n`` canonical words of a text."""
    places = [m.span() for m in _WORD.finditer(text)]
    if len(places) != n:  # a word whose canonical form falls apart
        places = [p for p in places for w in words_of([text[p[0] : p[1]]])[0].split(" ") if w]
    return np.array(places if len(places) == n else [(0, len(text))] * n, np.int64).reshape(-1, 2)


class _Items:
    """The items of a pass as one sequence of word numbers."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.numbers: dict[str, int] = {}
        self.words = np.fromiter((self.numbers.setdefault(w, len(self.numbers) + 2) for _, ws in items for w in ws), np.int32)  # 1 is the separator
        self.place = np.repeat(np.arange(len(items), dtype=np.int32), [len(ws) for _, ws in items])
        self.ids = np.array([i for i, _ in items], np.int64)

    def phrases(self, least: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrases, place of the item of each), ``block`` at a time."""
        if len(self.words) < least:
            return
        windows = np.lib.stride_tricks.sliding_window_view(self.words, least)
        whole = np.flatnonzero(self.place[: len(windows)] == self.place[least - 1 :])
        for i in range(0, len(whole), block):
            at = whole[i : i + block]
            yield windows[at].astype(np.int64), self.place[at]


def _prune(ids: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, position of each of its symbols in ``ids`` or -1): runs of at least ``least`` known words, each followed by a separator; ``ends`` holds where documents end."""
    cut = np.zeros(len(ids) + 1, bool)
    cut[ends] = True
    known = ids > 0
    starts = np.flatnonzero(known & (np.r_[True, ~known[:-1]] | cut[:-1]))
    stops = np.flatnonzero(known & (np.r_[~known[1:], True] | cut[1:])) + 1
    long = stops - starts >= least
    starts, stops = starts[long], stops[long]
    sizes = stops - starts + 1
    if not len(sizes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    origin = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
    last = np.cumsum(sizes) - 1
    seq = ids[np.minimum(origin, len(ids) - 1)].copy()
    seq[last] = 1
    origin[last] = -1
    return seq, origin


def _leaks(docs: DataFrame, items: list[tuple[int, list[str]]], id_col: str, text: str, least: int, shard_words: int, block_words: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(_Items(items))  # at most PASS_WORDS words
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "item_id", "word_start", "word_end", "char_start", "char_end"]

    def shard(ids: list, seqs: list[np.ndarray], origins: list[np.ndarray], docs_of: list[np.ndarray], places: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        seq, doc, origin, place = (np.concatenate(x) for x in (seqs, docs_of, origins, places))
        index = FMIndex(seq)
        found = []
        for phrases, of_item in shared.value.phrases(least, block_words):
            lo, hi = index.search(phrases)
            hit = np.flatnonzero(hi > lo)
            size = (hi - lo)[hit]
            rows = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo[hit], size)
            found.append((index.locate(rows), np.repeat(of_item[hit], size)))
        at = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
        item = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.int32)
        first, last = merged_spans(doc[at], item, origin[at], least)
        a, z = at[first], at[last] + least - 1
        return pa.RecordBatch.from_arrays([pa.array([ids[x] for x in doc[a]], kind), pa.array(shared.value.ids[item[first]]), pa.array(origin[a]), pa.array(origin[z] + 1), pa.array(place[a, 0]), pa.array(place[z, 1])], names=names)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        held: tuple[list[np.ndarray], ...] = ([], [], [], [])
        size = 0
        kind = None
        number = shared.value.numbers.get
        for b in batches:
            kind = b.column(0).type
            texts = b.column(1).to_pylist()
            words = [w.split(" ") if w else [] for w in words_of(texts)]
            n = np.array([len(w) for w in words], np.int64)
            flat = np.fromiter((number(x, 0) for w in words for x in w), np.int64, int(n.sum()))
            seq, origin = _prune(flat, np.cumsum(n)[:-1] if len(n) else n, least)
            if len(seq):
                begins = np.cumsum(n) - n
                origin = np.where(origin < 0, np.r_[-1, origin[:-1]], origin)  # a separator stands at the word before it
                doc = np.searchsorted(begins, origin, side="right") - 1
                used, doc_at = np.unique(doc, return_inverse=True)
                b_ids = b.column(0).to_pylist()
                first = np.cumsum(n[used]) - n[used]
                place = np.concatenate([word_places(texts[x], int(n[x])) for x in used])
                for to, x in zip(held, (seq, origin - begins[doc], doc_at + len(ids), place[origin - begins[doc] + first[doc_at]])):
                    to.append(x)
                ids += [b_ids[x] for x in used]
                size += len(seq)
            if size >= shard_words:
                yield shard(ids, *held, kind)
                ids, held, size = [], ([], [], [], []), 0
        if size:
            yield shard(ids, *held, kind)

    return docs.select(id_col, text).mapInArrow(search, f"`{id_col}` {kind}, item_id bigint, word_start bigint, word_end bigint, char_start bigint, char_end bigint")


def leaks(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = LEAST_WORDS, shard_words: int = SHARD_WORDS, block_words: int = BLOCK_WORDS, pass_words: int = PASS_WORDS) -> DataFrame:
    """(doc_id, item_id, word_start, word_end, char_start, char_end): the spans of each document, in words and in code points, that items share in ``least`` or more consecutive words.

    Words are compared without case, punctuation and encoding differences. Null and short
    texts leak nothing. Items are test material: they are streamed to the driver and searched
    in blocks of ``block_words`` phrases in the one index of a shard; the corpus is read once
    for each ``pass_words`` words of items. Repeated items are reported each. The documents
    are never shuffled; a document lies in one shard, so its spans are final there.
    """
    blocks: list[list[tuple[int, list[str]]]] = [[]]
    held = 0
    out: DataFrame | None = None
    for r in items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).where("i is not null and t is not null").toLocalIterator():
        words = words_of([r.t])[0].split(" ")
        if len(words) >= least:
            if held + len(words) > pass_words and blocks[-1]:
                blocks.append([])
                held = 0
            blocks[-1].append((r.i, words))
            held += len(words)
    for block in blocks:
        part = _leaks(docs, block, id_col, text, least, shard_words, block_words)
        out = part if out is None else out.unionByName(part)
    return out


def removals(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """(doc_id, char_start, char_end, items): the ranges of code points to remove from each document, overlapping and touching spans of all items merged, with the items concerned in order."""
    spans = leaks(docs, items, id_col=id_col, **options)
    own = Window.partitionBy(id_col).orderBy("char_start", "char_end", "item_id")  # the spans of one document
    before = F.max("char_end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("_new", F.coalesce(F.col("char_start") > before, F.lit(True)).cast("int"))
    grouped = marked.withColumn("_range", F.sum("_new").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return grouped.groupBy(id_col, "_range").agg(F.min("char_start").alias("char_start"), F.max("char_end").alias("char_end"), F.array_sort(F.collect_set("item_id")).alias("items")).drop("_range")


def found(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id) of :func:`leaks`, once each."""
    return leaks(docs, items, **options).select("doc_id", "item_id").distinct()


def item_report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(item_id, documents, spans, longest): for each leaked item its documents, spans, and words of the longest span."""
    return leaks(docs, items, **options).groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.count(F.lit(1)).alias("spans"), F.max(F.col("word_end") - F.col("word_start")).alias("longest"))
