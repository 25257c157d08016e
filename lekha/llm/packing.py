"""Filling containers of fixed capacity with texts, by mixture-controlled packing.

Texts are spread over lanes along the hash of their identifier, so no source or author makes
a large lane; every source's hash range is cut by prefix sums of its tokens, so that each
lane gets its part of each source and no lane's deficit is left to the next. In a lane, deficit round-robin over source queues fills one window of containers
after another to the sources' target shares of tokens; a window's items go, largest first,
into the open container that they fill best. A window is closed before the next begins: the
items of its least filled containers go back to their queues. Deficits carry over from window
to window.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lekha.session import materialize

#: A file of the public tokenizers (their folder is described on the box); ranks of a byte-level BPE.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the published split pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Hash ranges for each lane, at whose bounds the lanes of a source are cut.
CELLS = 64
#: Tokens per lane, windows per lane at least, containers per window, and the share of a window's containers that may give their items back.
LANE_TOKENS, LANE_WINDOWS, WINDOW, REOPENED = 8_000_000, 16, 256, 1 / 32
#: A container with this share of room or less stays as it is.
FULL = 0.01
#: A tokenizer file that is larger is refused, since it is broadcast.
TOKENIZER_LIMIT = 64 * 2**20


@lru_cache(2)
def _counter(vocabulary: bytes) -> Callable[[str], int]:
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    encode = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda text: len(encode(text))


def token_sizes(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", source: str = "source", tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, tokens): tokens of each whole text; null texts have 0. The tokenizer file (under TOKENIZER_LIMIT bytes) is read by the driver and broadcast."""
    kind = docs.schema[id_col].dataType.simpleString()
    file = Path(tokenizer)
    if file.stat().st_size > TOKENIZER_LIMIT:
        raise ValueError(f"{tokenizer} is larger than {TOKENIZER_LIMIT} bytes")
    vocabulary = docs.sparkSession.sparkContext.broadcast(file.read_bytes())

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = _counter(vocabulary.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([size(t) if t else 0 for t in b.column(2).to_pylist()], pa.int64())], names=[id_col, "source", "tokens"])

    return docs.select(F.col(id_col), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).alias("_t")).mapInArrow(sizes, f"`{id_col}` {kind}, source string, tokens bigint")


def pack_lane(items: list[tuple[int, str, int]], capacity: int, shares: dict[str, float], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(item, container, token_start, token_end, window) for items (number, source, tokens); containers and windows are numbered from 0.

    An item over the capacity gives full containers and a remainder; nothing else is cut. All
    pieces are drawn through the windows and charged to their source. A container belongs to
    one window. Sources without a share are drawn when the others are empty.
    """
    out: list[tuple[int, int, int, int, int]] = []
    queues: dict[str, deque[tuple[int, int, int]]] = {}
    source_of = {}
    for number, source, tokens in items:
        source_of[number] = source
        q = queues.setdefault(source, deque())
        at = 0
        while tokens - at > capacity:
            q.append((number, at, at + capacity))
            at += capacity
        q.append((number, at, tokens))
    deficit = dict.fromkeys(queues, 0.0)
    made = w = back = 0
    while queues:
        room = window * capacity - back
        live = sum(shares.get(s, 0.0) for s in queues)
        batch: list[tuple[int, int, int]] = []
        for s in queues:
            deficit[s] += room * (shares.get(s, 0.0) / live if live else 1 / len(queues))
        for s in sorted(queues, key=lambda s: (-deficit[s], s)):
            q = queues[s]
            while q and q[0][2] - q[0][1] <= deficit[s]:
                item = q.popleft()
                deficit[s] -= item[2] - item[1]
                batch.append(item)
        if not batch:  # every head is larger than its deficit: the largest deficit gives one item on credit
            s = max(sorted(s for s in queues if queues[s]), key=lambda s: deficit[s])
            item = queues[s].popleft()
            deficit[s] -= item[2] - item[1]
            batch.append(item)
        batch.sort(key=lambda x: (x[1] - x[2], x[0], x[1]))
        open_by_room: list[tuple[int, int]] = []
        boxes: list[list[tuple[int, int, int]]] = []
        for item in batch:
            size = item[2] - item[1]
            i = bisect_left(open_by_room, (size, -1))
            if i < len(open_by_room):
                left, box = open_by_room.pop(i)
            else:
                left, box = capacity, len(boxes)
                boxes.append([])
            boxes[box].append(item)
            if left > size:
                insort(open_by_room, (left - size, box))
        back = 0
        if any(queues.values()):
            loose = [box for left, box in reversed(open_by_room) if left > FULL * capacity]
            for box in loose[: min(int(REOPENED * window) or 1, len(boxes) - 1)]:
                for item in boxes[box]:
                    s = source_of[item[0]]
                    queues[s].appendleft(item)
                    deficit[s] += item[2] - item[1]
                    back += item[2] - item[1]
                boxes[box] = []
        for box in boxes:
            out += [(number, made, a, b, w) for number, a, b in box]
            made += bool(box)
        w += 1
        queues = {s: q for s, q in queues.items() if q}
    return out


def packed(docs: DataFrame, packs: DataFrame, targets: DataFrame | None = None, *, id_col: str = "doc_id", text: str = "text", source: str = "source", tokenizer: str = TOKENIZER, lane_tokens: int = LANE_TOKENS, window: int = WINDOW, sizes: DataFrame | None = None) -> DataFrame:
    """(pack_name, capacity_tokens, window_id, container_id, doc_id, source, token_start, token_end): where each text, or each piece of one larger than a container, lies.

    Every text is packed once for each pack. Null and empty texts take a place of 0 tokens.
    Containers are never over capacity and belong to one window; a window holds the sources'
    target shares of tokens as long as all sources last. ``targets`` (source, target_share)
    gives the shares, scaled to sum 1; without it they are those of the whole corpus, so all
    sources last to the end. Packs of null or non-positive capacity are left out, repeated
    pack rows count once. ``packs`` and ``targets`` are configuration tables. Null sources
    are one source. A lane holds ``lane_tokens``, or LANE_WINDOWS windows if these are more.
    """
    wanted = sorted(tuple(r) for r in packs.where("pack_name is not null and capacity_tokens > 0").select("pack_name", "capacity_tokens").distinct().collect())
    schema = docs.schema[id_col].dataType.simpleString()
    schema = f"pack_name string, capacity_tokens bigint, window_id bigint, container_id bigint, `{id_col}` {schema}, source string, token_start bigint, token_end bigint"
    spark = docs.sparkSession
    if not wanted:
        return spark.createDataFrame([], schema)
    sized = materialize(token_sizes(docs, id_col=id_col, text=text, source=source, tokenizer=tokenizer), "p7sizes") if sizes is None else sizes
    total = sized.agg(F.sum("tokens")).first()[0] or 0
    each = []
    for name, capacity in wanted:
        lanes = max(1, -(-total // max(lane_tokens, LANE_WINDOWS * window * capacity)))
        cell = F.pmod(F.xxhash64(F.col(id_col), F.lit(1)), F.lit(lanes * CELLS))
        each.append(F.struct(F.lit(name).alias("pack_name"), F.lit(capacity).cast("bigint").alias("capacity_tokens"), F.lit(lanes).alias("lanes"), cell.alias("cell")))
    every = sized.select(F.explode(F.array(*each)).alias("p"), id_col, "source", "tokens").select("p.*", id_col, "source", "tokens")
    pack, keys = ["pack_name", "capacity_tokens"], ["pack_name", "capacity_tokens", "lane"]
    cells = every.groupBy(*pack, "lanes", "source", "cell").agg(F.sum("tokens").alias("t"))  # CELLS rows for each lane and source
    own = Window.partitionBy(*pack, "source")
    middle = (F.sum("t").over(own.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("t") / 2) / F.greatest(F.sum("t").over(own), F.lit(1))
    cells = materialize(cells.withColumn("lane", F.least(F.col("lanes") - 1, F.floor(middle * F.col("lanes"))).cast("int")), "p7cells")
    every = every.join(cells.select(*pack, "source", "cell", "lane").hint("merge"), [*pack, "source", "cell"]).select(*keys, id_col, "source", "tokens")
    by_lane = cells.groupBy(*keys, "source").agg(F.sum("t").alias("t"))
    if targets is None:  # what the lane holds, which is the corpus' share but for a part of a cell, so that all sources last to its end
        grid = by_lane.withColumn("share", F.col("t") / F.greatest(F.sum("t").over(Window.partitionBy(*keys)), F.lit(1)))
    else:
        asked = targets.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.col("target_share").cast("double").alias("s")).where("s > 0 and not isnan(s)").groupBy("source").agg(F.sum("s").alias("s"))
        whole = asked.agg(F.sum("s")).first()[0] or 1.0
        grid = by_lane.join(asked, "source", "left").withColumn("share", F.coalesce(F.col("s") / F.lit(float(whole)), F.lit(0.0)))
    guides = materialize(grid.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("source", "share"))).alias("plan")), "p7plans")  # a row per lane, an entry per source of it

    def lane(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        name, capacity, number = (k.as_py() for k in key)
        ids, sources, tokens = (left.column(c).to_pylist() for c in (id_col, "source", "tokens"))
        plan = dict(right.column("plan")[0].as_py()) if right.num_rows else {}
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, tokens[i]))
        got = pack_lane([(i, sources[i], tokens[i]) for i in order], capacity, plan, window)
        n = len(got)
        column = lambda k: pa.array([g[k] for g in got], pa.int64())
        numbered = lambda k: pa.array([number * 2**32 + g[k] for g in got], pa.int64())
        return pa.table(
            [pa.array([name] * n, pa.string()), pa.array([capacity] * n, pa.int64()), numbered(4), numbered(1), pa.array([ids[g[0]] for g in got], left.schema.field(id_col).type), pa.array([sources[g[0]] for g in got], pa.string()), column(2), column(3)],
            names=["pack_name", "capacity_tokens", "window_id", "container_id", id_col, "source", "token_start", "token_end"],
        )

    return every.groupBy(*keys).cogroup(guides.groupBy(*keys)).applyInArrow(lane, schema)


def pack_report(docs: DataFrame, packs: DataFrame, **options) -> DataFrame:
    """(pack_name, capacity_tokens, containers, tokens, least_containers, used): ``least_containers`` is the bound tokens / capacity, ``used`` the filled share of all containers."""
    got = packed(docs, packs, **options).groupBy("pack_name", "capacity_tokens").agg(F.countDistinct("container_id").alias("containers"), F.sum(F.col("token_end") - F.col("token_start")).alias("tokens"))
    return got.select("pack_name", "capacity_tokens", "containers", "tokens", F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least_containers"), (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("used"))


def mixture_report(docs: DataFrame, packs: DataFrame, targets: DataFrame | None = None, **options) -> DataFrame:
    """(pack_name, capacity_tokens, windows, full_windows, worst, median): how far, at most over the sources, a window's token shares are from the targets (those of the corpus without ``targets``); worst and median of the windows that are at least nine tenths full, since what is left at a lane's end makes a smaller one."""
    window = options.get("window", WINDOW)
    got = packed(docs, packs, targets, **options)
    one = materialize(got.groupBy("pack_name", "capacity_tokens", "window_id", "source").agg(F.sum(F.col("token_end") - F.col("token_start")).alias("t")), "p7windows")
    every = one.groupBy("pack_name", "capacity_tokens", "window_id").agg(F.sum("t").alias("w"))
    if targets is None:
        whole = one.groupBy("pack_name", "source").agg(F.sum("t").alias("s"))
    else:
        asked = targets.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.col("target_share").cast("double").alias("s")).where("s > 0 and not isnan(s)")
        whole = one.select("pack_name", "source").distinct().join(asked.groupBy("source").agg(F.sum("s").alias("s")), "source", "left").na.fill(0.0, ["s"])
    share = whole.withColumn("share", F.col("s") / F.sum("s").over(Window.partitionBy("pack_name"))).drop("s")
    off = every.join(share, "pack_name").join(one, ["pack_name", "capacity_tokens", "window_id", "source"], "left").groupBy("pack_name", "capacity_tokens", "window_id", "w").agg(F.max(F.abs(F.coalesce(F.col("t"), F.lit(0)) / F.greatest("w", F.lit(1)) - F.col("share"))).alias("off"))
    full = F.col("w") >= 0.9 * window * F.col("capacity_tokens")
    return off.groupBy("pack_name", "capacity_tokens").agg(F.count(F.lit(1)).alias("windows"), F.count_if(full).alias("full_windows"), F.max(F.when(full, F.col("off"))).alias("worst"), F.percentile_approx(F.when(full, F.col("off")), 0.5).alias("median"))
