"""Splits that keep related records together: hash-to-min components, then weighted rendezvous hashing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lekha.llm.pairkeys import pair_keys
from lekha.operators.skew import HOT_PARTS, join_group_values
from lekha.session import discard, materialize

#: With ``balance``, a component with more than this share of the rows is placed by remaining room instead of by hash; at most its inverse many are.
LARGE = 1 / HOT_PARTS


def hash_to_min(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label): label is the smallest node of the component; ``edges`` has node columns ``a`` and ``b`` (integers, non-null).

    Clusters are kept as (node, member) rows, never as one value, so a giant component is no
    giant row. In each round every node sends its cluster to the cluster's minimum and the
    minimum to every member; it ends when no cluster changes. The round count grows with the
    logarithm of the longest path. Raises if it is not stable after ``max_rounds``.
    """
    pairs = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    loops = pairs.select("a", F.col("a").alias("b"))
    clusters = materialize(pairs.unionByName(loops).distinct().select(F.col("a").alias("node"), F.col("b").alias("member")), "p6clusters")
    signature = lambda d: tuple(d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "member").cast("decimal(38,0)")), F.sum(F.xxhash64("member", "node", F.lit(1)).cast("decimal(38,0)"))).first())
    before = signature(clusters)
    for _ in range(max_rounds):
        least = clusters.groupBy("node").agg(F.min("member").alias("low"), F.count(F.lit(1)).alias("n"))
        sent = join_group_values(clusters, least, ["node"], "n", before[0])
        said = sent.select(F.explode(F.array(F.struct(F.col("low").alias("node"), F.col("member").alias("member")), F.struct(F.col("member").alias("node"), F.col("low").alias("member")))).alias("m"))
        old, clusters = clusters, materialize(said.select("m.node", "m.member").distinct(), "p6clusters")
        discard(old)
        now = signature(clusters)
        if now == before:
            return clusters.groupBy("node").agg(F.min("member").alias("label"))
        before = now
    raise RuntimeError(f"components not stable after {max_rounds} rounds")


def groups(df: DataFrame, *, id_col: str = "seq", source: str = "source_name", doc: str = "doc_key") -> DataFrame:
    """(seq, first_seq): every row with the smallest identifier of its group.

    Rows are related when their Telugu sides are the same apart from formatting (null equals
    empty) or when source (without case and outer spaces) and document agree, both non-null;
    also through further rows. Identifiers must be unique.
    """
    keyed = materialize(pair_keys(df, want=["te1", "te2", "doc1", "doc2"], keep=[], id_col=id_col, source=source, doc=doc).withColumnRenamed(id_col, "seq"), "p6keys")
    total = keyed.count()
    by_text = keyed.groupBy("te1", "te2").agg(F.min("seq").alias("te_first"), F.count(F.lit(1)).alias("te_n"))
    by_doc = keyed.where("doc1 is not null").groupBy("doc1", "doc2").agg(F.min("seq").alias("doc_first"), F.count(F.lit(1)).alias("doc_n"))
    rows = join_group_values(keyed, by_text.where("te_n > 1"), ["te1", "te2"], "te_n", total, how="left").select("seq", "te_first", "doc1", "doc2")
    rows = materialize(join_group_values(rows, by_doc.where("doc_n > 1"), ["doc1", "doc2"], "doc_n", total, how="left").select("seq", "te_first", "doc_first"), "p6rows")
    # a text of one row joins nothing, so only repeated texts tie documents together
    edges = rows.where("te_first is not null and doc_first is not null and te_first != doc_first").select(F.col("te_first").alias("a"), F.col("doc_first").alias("b")).distinct()
    labels = materialize(hash_to_min(edges).where("node != label"), "p6labels")
    discard(keyed)
    rows = rows.withColumn("node", F.coalesce("doc_first", "te_first", "seq"))
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    found = materialize(labels.join(sizes, "node"), "p6found")
    labelled = join_group_values(rows.select("seq", "node"), found, ["node"], "n", total, how="left")
    return labelled.select("seq", F.coalesce("label", "node").alias("first_seq"))


def found(df: DataFrame, **options) -> DataFrame:
    """(first_seq, seq): rows of :func:`groups` that are not the first of their group."""
    return groups(df, **options).where("seq != first_seq").select("first_seq", "seq")


def splits(df: DataFrame, shares: DataFrame, *, seed: int = 0, balance: bool = False, **options) -> DataFrame:
    """(seq, first_seq, split): a split for every row, one per group, in the proportions of ``shares`` (split_name, share).

    A group goes to the split with the smallest -ln(u)/share, u being a hash of group and
    split (weighted rendezvous), so a group's split depends on nothing but itself and the
    shares, and a changed share moves few groups. The proportions hold in expectation; with
    few large groups they are off by chance (see :func:`split_report`). ``balance`` places
    groups above ``LARGE`` of the rows by remaining room instead, largest first, at the price
    that added rows may move groups. Shares are scaled to sum 1; null, NaN and non-positive
    shares get no rows; repeated names add up. Without any share the split is null.
    """
    spark = df.sparkSession
    wanted = {r.split_name: r.w for r in shares.where("split_name is not null and share > 0 and not isnan(share)").groupBy("split_name").agg(F.sum("share").alias("w")).collect()}
    member = materialize(groups(df, **options), "p6groups")
    if not wanted:
        return member.withColumn("split", F.lit(None).cast("string"))
    weights, placed = wanted, []
    if balance:
        total, whole = member.count(), sum(wanted.values())
        room = {k: total * w / whole for k, w in wanted.items()}
        sizes = member.groupBy("first_seq").agg(F.count(F.lit(1)).alias("n"))
        for r in sizes.where(F.col("n") > max(1, total * LARGE)).orderBy(F.desc("n"), "first_seq").collect():  # at most 1/LARGE groups
            best = max(sorted(room), key=lambda k: room[k])
            room[best] -= r.n
            placed.append((r.first_seq, best))
        weights = {k: v for k, v in room.items() if v > 0} or wanted
    u = lambda k: (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(k), F.lit(seed), "first_seq")), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    choice = F.array_min(F.array(*[F.struct((-F.ln(u(k)) / F.lit(float(w))).alias("cost"), F.lit(k).alias("name")) for k, w in sorted(weights.items())])).getField("name")
    if not placed:
        return member.withColumn("split", choice)
    large = spark.createDataFrame(placed, "first_seq bigint, _large string")
    return member.join(F.broadcast(large), "first_seq", "left").select("seq", "first_seq", F.coalesce("_large", choice).alias("split"))


def split_report(assigned: DataFrame, shares: DataFrame) -> DataFrame:
    """(split_name, share, rows, rows_share, groups): what :func:`splits` reached."""
    got = assigned.groupBy(F.col("split").alias("split_name")).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("first_seq").alias("groups"))
    all_rows = Window.partitionBy(F.lit(1))
    return shares.groupBy("split_name").agg(F.sum("share").alias("share")).join(got, "split_name", "left").select("split_name", "share", F.coalesce("rows", F.lit(0)).alias("rows"), (F.coalesce("rows", F.lit(0)) / F.sum("rows").over(all_rows)).alias("rows_share"), F.coalesce("groups", F.lit(0)).alias("groups"))
