"""File sources and sinks."""

from __future__ import annotations

import io
import json
import tarfile
import zipfile
from collections.abc import Iterator
from itertools import islice
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lekha.config import MANIFEST_OPTIONAL, MANIFEST_REQUIRED, EvalSlice
from lekha.functions import text

#: Lines of an archive member that are held at once.
LINES = 50_000
_FIXED = {"aksharantar": ("https://huggingface.co/datasets/ai4bharat/Aksharantar", "CC-BY-4.0"), "dakshina": ("https://github.com/google-research-datasets/dakshina", "CC-BY-SA-4.0")}


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: str, strict: bool = False, order: bool = False) -> DataFrame:
    """JSON lines with ``schema``; blank lines are skipped. ``order`` adds seq, the number of the line along the sorted paths (tolerant reading).

    Tolerant reading keeps undecodable lines as rows whose ``_corrupt`` holds the line;
    strict reading fails on the first.
    """
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)
    lines = ordered_lines(spark, paths) if order else spark.read.text(paths)
    lines = lines.where(text.strip(F.col("value")) != "")
    parsed = F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return lines.select(*(["seq"] if order else []), parsed.alias("r")).select(*(["seq"] if order else []), "r.*")


def ordered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(seq, filename, value): the lines of text files, numbered along the sorted paths and the order within each file, from 0.

    Spark packs files into tasks by size, so the scan does not give that order; each line's
    place is its file, the start of its block in it, and the order within the block.
    """
    m = F.col("_metadata")
    lines = spark.read.text(paths).select(m["file_path"].alias("path"), m["file_name"].alias("filename"), m["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    return numbered(lines.withColumn("_place", F.struct("path", "block", "at")), "_place", "seq").select("seq", "filename", "value")


def _records(df: DataFrame, source: str, url: str, licence: str, ts: str, sides: Column, extra: list[str] = ()) -> DataFrame:
    """RawRecord rows of ``sides``: array<struct<source_doc_id, text_raw, script_hint, ...>>."""
    rows = df.select(F.explode(sides).alias("s"), *extra).select("s.*", *extra)
    fixed = {"source_name": F.lit(source), "source_url": F.lit(url), "license_tag": F.lit(licence), "pull_timestamp_utc": F.lit(ts), "lang_hint": F.lit("te"), "row_hash": text.row_hash(F.col("text_raw"))}
    return rows.withColumns({k: v for k, v in fixed.items() if k not in rows.columns})


def zip_pairs(spark: SparkSession, path: str, ts: str, members: tuple[str, ...] = ("tel_train.json", "tel_valid.json", "tel_test.json")) -> DataFrame:
    """Word pairs from JSON lines in zip archives: two records per pair that name each other; pairs with a blank side are skipped, missing members too."""
    split_names = {m: m.removeprefix("tel_").removesuffix(".json") for m in members}

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for m in (m for m in members if m in z.namelist()):
                        with z.open(m) as f:
                            numbered_lines = enumerate(x.decode("utf-8") for x in f if x.strip())
                            while part := list(islice(numbered_lines, LINES)):
                                yield pd.DataFrame({"split": split_names[m], "line": [i for i, _ in part], "value": [x for _, x in part]})

    return pair_records(spark.read.format("binaryFile").load(path).select("content").mapInPandas(lines, "split string, line bigint, value string"), ts)


def pair_records(lines: DataFrame, ts: str) -> DataFrame:
    """Records of word pairs in JSON lines (columns ``split``, ``line`` from 0 and ``value``): two per pair that name each other; pairs with a blank side are skipped."""
    e = F.from_json("value", "`native word` string, `english word` string, unique_identifier string, source string, score double")
    e = lines.select("split", "line", e.alias("e")).select(text.strip(F.col("e.`native word`")).alias("te"), text.strip(F.col("e.`english word`")).alias("ro"), F.concat_ws("_", "split", F.coalesce("e.unique_identifier", F.concat(F.lit("line"), "line"))).alias("id"), F.coalesce("e.source", F.lit("unknown")).alias("aksharantar_source"), F.col("e.score").alias("aksharantar_score")).where("te != '' and ro != ''")
    one = lambda s, t, hint, other: F.struct(F.concat("id", F.lit(s)).alias("source_doc_id"), F.col(t).alias("text_raw"), F.lit(hint).alias("script_hint"), F.concat("id", F.lit(other)).alias("paired_with"))
    return _records(e, "aksharantar", *_FIXED["aksharantar"], ts, F.array(one("_te", "te", "telugu", "_ro"), one("_ro", "ro", "roman", "_te")), ["aksharantar_source", "aksharantar_score"])


def lexicon_records(lines: DataFrame, ts: str) -> DataFrame:
    """Records of a ragged tab-separated lexicon (columns ``line`` from 1 and ``value``): cell 0 is Telugu, each further non-blank cell a romanisation; comments and blank first cells are skipped."""
    cells = F.transform(F.split("value", "\t"), text.strip)
    rows = lines.where(~F.col("value").startswith("#")).select("line", cells.alias("c")).where(F.col("c")[0] != "")
    made = F.transform("c", lambda t, i: F.struct(F.concat_ws("_", F.lit("te_lex"), F.col("line"), i).alias("source_doc_id"), t.alias("text_raw"), F.when(i == 0, "telugu").otherwise("roman").alias("script_hint")))
    return _records(rows, "dakshina", *_FIXED["dakshina"], ts, F.filter(made, lambda x: x["text_raw"] != ""))


def tar_lexicon(spark: SparkSession, path: str, member: str, ts: str) -> DataFrame:
    """:func:`lexicon_records` of a member of tar archives."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                with tarfile.open(fileobj=io.BytesIO(content)) as t:
                    numbered_lines = enumerate((x.decode("utf-8").rstrip("\r\n") for x in t.extractfile(member)), 1)
                    while part := list(islice(numbered_lines, LINES)):
                        yield pd.DataFrame({"line": [i for i, _ in part], "value": [x for _, x in part]})

    return lexicon_records(spark.read.format("binaryFile").load(path).select("content").mapInPandas(lines, "line bigint, value string"), ts)


def table_pairs(spark: SparkSession, path: str, ts: str, source: str, url: str, licence: str, contact: str) -> DataFrame:
    """Records of a tab-separated table with header doc_id, roman_text, telugu_text: two per row, rows with a blank side are skipped."""
    rows = spark.read.csv(path, sep="\t", header=True, schema="doc_id string, roman_text string, telugu_text string", enforceSchema=False)
    e = rows.select(F.coalesce("doc_id", F.lit("")).alias("id"), text.strip(F.col("roman_text")).alias("ro"), text.strip(F.col("telugu_text")).alias("te"), F.lit(contact).alias("takedown_contact")).where("ro != '' and te != ''")
    one = lambda t, hint: F.struct(F.col("id").alias("source_doc_id"), F.col(t).alias("text_raw"), F.lit(hint).alias("script_hint"))
    return _records(e, source, url, licence, ts, F.array(one("ro", "roman"), one("te", "telugu")), ["takedown_contact"])


def numbered(df: DataFrame, order: str, name: str = "n") -> DataFrame:
    """Adds the place of each row, from 0, in the order of a column; a range-partitioned sort, no one-task window over the rows."""
    from lekha.session import materialize

    ranked = materialize(df.orderBy(order).withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))), "numbered")
    sizes = ranked.groupBy("_part").agg(F.count(F.lit(1)).alias("_c"))
    starts = sizes.select("_part", (F.sum("_c").over(Window.orderBy("_part")) - F.col("_c")).alias("_from"))  # a row per partition
    return ranked.join(F.broadcast(starts), "_part").withColumn(name, F.col("_from") + F.col("_row")).drop("_part", "_row", "_from")


def parallel_rows(df: DataFrame, ts: str, column: str = "tgt", order: str = "seq", most: int | None = 300_000, contact: str = "", url: str = "https://huggingface.co/datasets/ai4bharat/samanantar") -> DataFrame:
    """The first ``most`` (None: all) Telugu sentences of 15 to 300 characters; identifiers number the kept rows."""
    t = text.strip(F.coalesce(column, F.lit("")))
    kept = numbered(df.select(order, t.alias("t")).where(F.char_length("t").between(15, 300) & text.is_mostly(F.col("t"), 0.3)), order)
    kept = kept if most is None else kept.where(F.col("n") < most)
    sides = F.array(F.struct(F.concat(F.lit("sam_te_"), F.col("n").cast("string")).alias("source_doc_id"), F.col("t").alias("text_raw"), F.lit("telugu").alias("script_hint")))
    return _records(kept.withColumn("takedown_contact", F.lit(contact)), "samanantar", url, "CC-BY-NC-4.0", ts, sides, ["takedown_contact"])


def article_sentences(df: DataFrame, ts: str, id_col: str = "id", column: str = "text", title: str = "title", url: str = "url") -> DataFrame:
    """Telugu sentences of articles: parts between line breaks and dandas of 20 to 400 characters; identifiers number the kept parts of an article."""
    parts = F.filter(F.transform(F.split(F.coalesce(column, F.lit("")), r"[\n।]+"), text.strip), lambda s: F.char_length(s).between(20, 400) & text.is_mostly(s, 0.4))
    made = F.transform(parts, lambda s, i: F.struct(F.concat(F.lit("wiki_"), F.col(id_col).cast("string"), F.lit("_s"), i).alias("source_doc_id"), s.alias("text_raw"), F.lit("telugu").alias("script_hint"), F.col(url).alias("source_url"), F.col(title).alias("article_title")))
    return _records(df, "wikipedia_te", "", "CC-BY-SA-3.0", ts, made)


def snapshot_index(df: DataFrame, name: str = "filename", size: str = "size_bytes", order: str = "seq", sample: int = 5) -> DataFrame:
    """(filename, source_name, pull_date, record_count, size_bytes, row_hashes_sample): an entry per snapshot file with a dated name; the sample is the first five hashes.

    Two scans: counts, combined on the map side, and the first rows of each file, of which
    every map task passes on ``sample`` at most, so a huge file is no huge task or value.
    """
    pattern = r"^(.+?)_(\d{8})\.jsonl$"
    rows = df.where(F.regexp_extract(name, pattern, 1) != "")
    counts = rows.groupBy(name).agg(F.count(F.lit(1)).alias("record_count"), F.max(size).alias("size_bytes"))
    first = rows.select(name, order, "row_hash").withColumn("_n", F.row_number().over(Window.partitionBy(name).orderBy(order))).where(F.col("_n") <= sample)
    picked = first.groupBy(name).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "row_hash"))), lambda x: x["row_hash"]).alias("row_hashes_sample"))
    return counts.join(picked, name).select(F.col(name).alias("filename"), F.regexp_extract(name, pattern, 1).alias("source_name"), F.regexp_extract(name, pattern, 2).alias("pull_date"), "record_count", "size_bytes", "row_hashes_sample")


def snapshot_rows(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines of snapshot files as rows for :func:`snapshot_index`."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("filename"), F.col("_metadata.file_size").alias("size_bytes"), F.monotonically_increasing_id().alias("seq"))
    return lines.where(F.trim("value") != "").select("filename", "size_bytes", "seq", F.coalesce(F.get_json_object("value", "$.row_hash"), F.lit("")).alias("row_hash"))


def config_yaml(path: str) -> dict:
    """A YAML configuration, where a YAML library is installed."""
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))


def eval_config(config: dict) -> tuple[tuple[EvalSlice, ...], tuple[tuple[str, float], ...]]:
    """(slices, targets) for :func:`lekha.operators.evaluate.by_slice` and ``acceptance`` from a configuration: ``slices`` is a list of names and filters, ``acceptance_targets`` maps cer_{slice}_max to a rate."""
    def one(x: dict) -> EvalSlice:
        kind = x.get("filter")
        share = float(x.get("min_english_word_ratio", 0.2)) if kind == "roman_has_english_words" else None
        words = tuple(x.get("english_words") or ("\0",)) if kind == "roman_has_actual_english" else ()
        return EvalSlice(x["name"], tuple(x.get("source_names") or ()), tuple(x.get("pair_sources") or ()), int(x.get("min_roman_length") or 0), share, words)

    slices = tuple(map(one, config.get("slices") or ()))
    targets = tuple((k.removeprefix("cer_").removesuffix("_max"), float(v)) for k, v in (config.get("acceptance_targets") or {}).items() if k.startswith("cer_") and k.endswith("_max"))
    return slices, targets


# ---- sinks ----------------------------------------------------------------------------------------------------------


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines; refuses an existing target unless ``mode`` is append or overwrite. Null fields are kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """An immutable snapshot, by source."""
    df.write.mode("errorifexists").partitionBy("source_name").parquet(path)


def write_routed(df: DataFrame, path: str, column: str) -> None:
    """One folder per value of ``column`` (route or split), written in one pass."""
    df.write.mode("errorifexists").partitionBy(column).parquet(path)


def write_manifest(spark: SparkSession, path: str, **fields) -> None:
    """One JSON object. The required fields must pass the manifest check; further fields (counts by split or category, model, files) are free."""
    from lekha.operators.curate import validate_manifests

    known = [c for c in (*MANIFEST_REQUIRED, *MANIFEST_OPTIONAL) if c in fields]
    row = spark.createDataFrame([tuple(fields[c] for c in known)], ", ".join(f"{c} {'bigint' if c == 'record_count' else 'string'}" for c in known))
    if not (checked := validate_manifests(row).first()).passed:
        raise ValueError(f"manifest: {checked.reason}")
    spark.createDataFrame([(json.dumps(fields, ensure_ascii=False),)], "value string").coalesce(1).write.mode("errorifexists").text(path)
