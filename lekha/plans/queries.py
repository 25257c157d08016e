"""Queries of the core for the driver, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lekha.config import NearDup
from lekha.functions import rules, text, tokens, translit
from lekha.operators import curate, evaluate
from lekha.plans import pipeline
from lekha.sources import files, generated
from lekha.session import new_folder, table

Query = Callable[[SparkSession, str], DataFrame]


def _raw(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "raw_records")


def _pairs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "translit_pairs")


def _clean(s: SparkSession, d: str) -> DataFrame:
    return _raw(s, d).transform(curate.normalized_rows).transform(curate.clean_rows)


def _eval(s: SparkSession, d: str) -> DataFrame:
    """Held-out pairs in the reverse direction: the rule romanisation as prediction, the Roman side as reference."""
    held = _pairs(s, d).where("split in ('val', 'test') and roman_text is not null")
    return held.select("seq", "split", F.lower(F.trim("source_name")).alias("source_name"), "pair_source", F.col("telugu_text").alias("roman_text"), F.col("roman_text").alias("telugu_text"), translit.romanize(F.col("telugu_text")).alias("prediction"))


def _synthetic_answers(s: SparkSession, d: str) -> DataFrame:
    """Model answers as JSON arrays, one per row of llm_pairs."""
    return table(s, d, "llm_pairs").select("seq", "category", F.to_json(F.array(F.struct("roman_text", "telugu_text"))).alias("answer"))


def _v4(s: SparkSession, d: str) -> DataFrame:
    train = _pairs(s, d).where("split = 'train'").select(*[c for c in ("pair_id", "roman_text", "telugu_text", "source_name", "license_tag", "pair_source", "quality_score", "confidence", "review_status", "created_at", "augmentation_variant")])
    return curate.append_generated(train, curate.uuid_pairs(_raw(s, d)))


#: An evaluation configuration with all kinds of filters.
_CONFIG = {
    "slices": [{"name": "english", "filter": "roman_has_english_words", "min_english_word_ratio": 0.2}, {"name": "listed", "filter": "roman_has_actual_english", "english_words": ["bus", "office", "phone", "time"]}, {"name": "short", "pair_sources": ["direct"], "source_names": ["aksharantar"], "min_roman_length": 12}],
    "acceptance_targets": {"cer_english_max": 0.5},
}


def _answered(te: str | None, ro: str | None) -> str:
    """A reviewer that answers in four ways, by the length of the Roman side."""
    n = len(ro or "")
    return ['Sure: {"confidence_score": 0.75, "reason_code": "plausible", "flag_for_review": false}.', '{"reason_code": "wrong_word", "flag_for_review": true}', "no idea", '{"confidence_score": '][n % 4]


def _written(s: SparkSession, label: str, write: Callable[[str], None]) -> str:
    path = new_folder(s, label)
    write(path)
    return path


def _tolerant(s: SparkSession, d: str) -> DataFrame:
    lines = _raw(s, d).select(F.when(F.col("seq") % 7 == 0, "not json").when(F.col("seq") % 5 == 0, " ").otherwise(F.to_json(F.struct("seq", "text_raw"))).alias("value"))
    path = _written(s, "lines", lambda p: lines.write.text(p))
    return files.read_jsonl(s, path, "seq bigint, text_raw string").groupBy(F.col("_corrupt").isNotNull().alias("corrupt")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("text_raw")).alias("chars"))


def _appended(s: SparkSession, d: str) -> DataFrame:
    path = new_folder(s, "append")
    for _ in range(2):
        files.write_jsonl(_raw(s, d).select("seq", "category"), path, mode="append")
    return files.read_jsonl(s, path, "seq bigint, category string", strict=True).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def _manifest(s: SparkSession, d: str) -> DataFrame:
    n = _raw(s, d).count()
    path = _written(s, "manifest", lambda p: files.write_manifest(s, p, run_id="r", source_name="all", pull_timestamp_utc="t", record_count=n, output_file="f", license_tag="MIT", category_counts={"food": 1}))
    return s.read.schema("run_id string, record_count bigint, category_counts map<string,bigint>").json(path).select("run_id", "record_count", F.col("category_counts")["food"].alias("food"))


def _tabbed(s: SparkSession, d: str) -> DataFrame:
    flat = lambda c: F.regexp_replace(c, r'[\t\r\n"\\\\]', " ").alias(c)
    path = _written(s, "table", lambda p: _pairs(s, d).select(F.col("seq").cast("string").alias("doc_id"), flat("roman_text"), flat("telugu_text")).write.option("sep", "\t").option("header", True).csv(p))
    return files.table_pairs(s, path, "t", "src", "u", "MIT", "c").select("source_doc_id", "text_raw", "script_hint", "row_hash")


def _ordered(s: SparkSession, d: str) -> DataFrame:
    path = _written(s, "ordered", lambda p: _pairs(s, d).select("seq").orderBy("seq").select(F.col("seq").cast("string").alias("value")).write.text(p))
    return files.ordered_lines(s, path).select("seq", "value")


def queries() -> dict[str, Query]:
    """Name -> query over the tables of a folder."""
    norm = lambda s, d: curate.normalize(_raw(s, d))
    show = ["roman_text", "telugu_text", "quality_score", "confidence", "review_status"]
    return {
        "normalize_records": lambda s, d: norm(s, d).select("seq", "text_normalized", "script_detected", "drop_reason"),
        "normalize_reasons": lambda s, d: curate.reason_counts(norm(s, d), "drop_reason"),
        "normalize_report": lambda s, d: curate.stage_report(norm(s, d), "normalize", "drop_reason").select("stage", "input_count", "output_count", "drop_count"),
        "script_profile": lambda s, d: norm(s, d).groupBy("source_name", "script_detected").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(text.script_share(F.col("text_normalized"))), 6).alias("share")),
        "row_hashes": lambda s, d: _raw(s, d).select("seq", text.row_hash(F.col("text_raw")).alias("computed"), (text.row_hash(F.col("text_raw")) == F.col("row_hash")).alias("same")),
        "junk_kept": lambda s, d: curate.clean_rows(curate.normalized_rows(_raw(s, d))).select("seq", "text_normalized"),
        "junk_rows": lambda s, d: curate.junk(norm(s, d)).select("seq", "junk_reason"),
        "junk_document_lines": lambda s, d: curate.junk(table(s, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text_raw"))).groupBy("junk_reason").agg(F.count(F.lit(1)).alias("n")),
        "validate_records": lambda s, d: curate.validate_records(_raw(s, d)).select("seq", "passed", "reason", "action"),
        "validate_manifests": lambda s, d: curate.validate_manifests(table(s, d, "pull_manifests")).select("run_id", "source_name", "passed", "reason"),
        "licence_tiers": lambda s, d: curate.licence_tiers(_pairs(s, d)).groupBy("license_tag", "tier", "allows_training").agg(F.count(F.lit(1)).alias("n")),
        "lexicon_pairs": lambda s, d: curate.lexicon_pairs(_clean(s, d).where("source_name = 'dakshina'")).select(*show),
        "crossref_pairs": lambda s, d: curate.crossref_pairs(_clean(s, d).where("source_name = 'aksharantar'")).select(*show),
        "suffix_pairs": lambda s, d: curate.suffix_pairs(_clean(s, d).where("source_name = 'synthetic_gemma4'")).select(*show),
        "uuid_pairs": lambda s, d: curate.uuid_pairs(_raw(s, d)),
        "pending_pairs": lambda s, d: curate.pending_pairs(_clean(s, d).where("source_name in ('wikipedia_te', 'samanantar')")).select("telugu_text", "source_name", "license_tag", "review_status"),
        "pair_status_counts": lambda s, d: curate.build_pairs(_clean(s, d)).groupBy("source_name", "review_status").agg(F.count(F.lit(1)).alias("n")),
        "snapshot_index": lambda s, d: files.snapshot_index(_raw(s, d).select("seq", "row_hash", F.lit(0).cast("bigint").alias("size_bytes"), F.concat_ws("", F.col("source_name"), F.lit("_"), F.translate(F.substring("pull_timestamp_utc", 1, 10), "-", ""), F.lit(".jsonl")).alias("filename"))).withColumn("row_hashes_sample", F.array_join("row_hashes_sample", ",")),
        "fill_pending": lambda s, d: curate.fill_pending(_pairs(s, d)).select("seq", "roman_text", "pair_source", "quality_score", "confidence", "review_status"),
        "romanize": lambda s, d: _pairs(s, d).select("seq", translit.romanize(F.col("telugu_text")).alias("roman")),
        "romanize_variants": lambda s, d: _pairs(s, d).select("seq", F.array_join(translit.romanize_variants(F.col("telugu_text")), "|").alias("variants")),
        "rule_transliterate": lambda s, d: translit.with_telugu(_pairs(s, d).select("seq", "roman_text"), "roman_text", "telugu").select("seq", "telugu"),
        "improve_pairs": lambda s, d: curate.improve_pairs(_pairs(s, d)).select("seq", "telugu_text", "roman_text", "pair_source", "quality_score"),
        "clause_split": lambda s, d: table(s, d, "documents").select("doc_id", F.posexplode(curate.clauses(F.col("text"))).alias("at", "clause")),
        "article_sentences": lambda s, d: files.article_sentences(table(s, d, "documents").select(F.col("doc_id").alias("id"), "text", F.lit("").alias("title"), F.lit("").alias("url")), "").select("source_doc_id", "text_raw", "row_hash"),
        "parallel_rows": lambda s, d: files.parallel_rows(table(s, d, "documents").select(F.col("doc_id").alias("seq"), F.col("text").alias("tgt")), "").select("source_doc_id", "text_raw"),
        "word_variants": lambda s, d: _pairs(s, d).where("roman_text is not null").select("seq", F.posexplode(rules.word_candidates(F.col("roman_text"))).alias("at", "variant")),
        "tier_variants": lambda s, d: curate.with_variants(_pairs(s, d).where("roman_text is not null")).select("seq", F.posexplode("variants").alias("at", "variant")),
        "augment_pairs": lambda s, d: curate.augment(_pairs(s, d)).groupBy("pair_source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("confidence") * 10_000).cast("bigint")).alias("confidence")),
        "exact_dedup": lambda s, d: curate.exact_dedup(_pairs(s, d)).select("seq"),
        "near_dedup": lambda s, d: curate.near_dedup(_pairs(s, d), near=NearDup(max_rows=None)).select("seq"),
        "score_pairs": lambda s, d: curate.score(_pairs(s, d)).select("seq", "quality_score", "review_status", F.array_join("score_reasons", ",").alias("reasons")),
        "route_counts": lambda s, d: pipeline.route_counts(curate.score(_pairs(s, d))),
        "split_rows": lambda s, d: curate.split(_pairs(s, d).drop("split")).select("seq", "split"),
        "split_counts": lambda s, d: curate.split(_pairs(s, d).drop("split")).groupBy("split").agg(F.count(F.lit(1)).alias("n")),
        "split_leakage": lambda s, d: curate.leakage(_pairs(s, d)),
        "append_generated": lambda s, d: _v4(s, d).groupBy("source_name", "pair_source").agg(F.count(F.lit(1)).alias("n")),
        "generated_leakage": lambda s, d: curate.leakage(_v4(s, d).select("telugu_text", F.lit("train").alias("split")).unionByName(_pairs(s, d).where("split = 'test'").select("telugu_text", "split"))),
        "drift": lambda s, d: curate.drift(_raw(s, d).select(F.col("text_raw").alias("text")), _pairs(s, d).select(F.col("telugu_text").alias("text"))).withColumn("alerts", F.array_join("alerts", ",")),
        "synthetic_refused": lambda s, d: table(s, d, "llm_pairs").groupBy(text.synthetic_reason(F.col("roman_text"), F.col("telugu_text")).alias("reason")).agg(F.count(F.lit(1)).alias("n")),
        "generated_accepted": lambda s, d: generated.accepted_pairs(_synthetic_answers(s, d), _raw(s, d)).select("roman_text", "row_hash"),
        "generated_trace": lambda s, d: generated.trace(_synthetic_answers(s, d)).groupBy("parsed", "accepted").agg(F.count(F.lit(1)).alias("n")),
        "category_counts": lambda s, d: generated.category_counts(_raw(s, d)),
        "seen_filter": lambda s, d: curate.seen_filter(_pairs(s, d).where("roman_text is not null"), _raw(s, d)).select("seq", "row_hash"),
        "review_scores": lambda s, d: generated.review_scores(_pairs(s, d).where("review_status = 'review'")).select("seq", "ollama_score", "ollama_reason", "ollama_flag"),
        "eval_overall": lambda s, d: evaluate.overall(_eval(s, d)),
        "eval_slices": lambda s, d: evaluate.by_slice(_eval(s, d)),
        "eval_micro": lambda s, d: evaluate.micro_cer(_eval(s, d)),
        "eval_acceptance": lambda s, d: evaluate.acceptance(evaluate.by_slice(_eval(s, d))),
        "eval_card": lambda s, d: evaluate.card_metrics(evaluate.by_slice(_eval(s, d))),
        "eval_compare": lambda s, d: evaluate.compare(evaluate.by_slice(_eval(s, d).where("split = 'val'")), evaluate.by_slice(_eval(s, d).where("split = 'test'"))),
        "confusion_summary": lambda s, d: evaluate.confusion_summary(_eval(s, d)),
        "confusion_groups": lambda s, d: evaluate.confusion_groups(_eval(s, d)),
        "confusion_worst": lambda s, d: evaluate.worst(_eval(s, d)).select("seq", "cer"),
        "confusion_chars": lambda s, d: evaluate.top_char_errors(_eval(s, d)),
        "divergent": lambda s, d: evaluate.divergent(_eval(s, d).withColumn("other", F.col("roman_text")), "prediction", "other").select("seq", F.round("gap", 6).alias("gap")),
        "clean_prompts": lambda s, d: _pairs(s, d).where(text.is_clean_prompt(F.col("roman_text"))).select("seq"),
        "sample_rows": lambda s, d: evaluate.sample(_pairs(s, d).where(text.is_clean_prompt(F.col("roman_text"))), 50).select("seq"),
        "curated_pairs": lambda s, d: pipeline.route_counts(pipeline.curated_pairs(_raw(s, d))),
        "curated_exact": lambda s, d: pipeline.curated_pairs(_raw(s, d), near=None).select("snapshot", "source_name", "telugu_text", "roman_text", "pair_source", "quality_score", "review_status", F.array_join("score_reasons", ",").alias("reasons")),
        "dedup_report": lambda s, d: curate.dedup_report(_pairs(s, d), near=None),
        "spelling_fixes": lambda s, d: _pairs(s, d).select("seq", text.shorten_ey(F.concat("roman_text", F.lit("ey oley"))).alias("roman"), text.fix_doubled_signs(F.regexp_replace("telugu_text", "(ా)", "$1ఆ")).alias("telugu")),
        "eval_configured": lambda s, d: evaluate.by_slice(_eval(s, d), files.eval_config(_CONFIG)[0]),
        "eval_targets": lambda s, d: evaluate.acceptance(evaluate.by_slice(_eval(s, d), files.eval_config(_CONFIG)[0]), files.eval_config(_CONFIG)[1]),
        "review_answers": lambda s, d: generated.review_scores(_pairs(s, d).where("review_status = 'review'"), _answered, most=None).select("seq", "ollama_score", "ollama_reason", "ollama_flag", "ollama_model"),
        "predictions": lambda s, d: generated.predictions(_pairs(s, d).select("seq", "roman_text"), lambda ts: [t.replace(" ", "_") for t in ts]).select("seq", "prediction"),
        "union_sources": lambda s, d: pipeline.union_sources(_pairs(s, d).select("seq", "pair_source", "split"), None, table(s, d, "llm_pairs").select("seq", "pair_source", "category")).groupBy("pair_source", "split", "category").agg(F.count(F.lit(1)).alias("n")),
        "scored_else_deduped": lambda s, d: pipeline.scored_else_deduped([], [_pairs(s, d).where("split = 'val'").select("seq"), _pairs(s, d).where("split = 'test'").select("seq")]).unionByName(pipeline.scored_else_deduped([_pairs(s, d).where("split = 'train'").select("seq")], [_pairs(s, d).select("seq")])),
        "shuffled_places": lambda s, d: files.numbered(_pairs(s, d).select("seq", F.struct(text.draw("seq", 42), "seq").alias("k")), "k", "place").select("seq", "place"),
        "dataset_card": lambda s, d: evaluate.dataset_card(_pairs(s, d)),
        "jsonl_files": lambda s, d: files.read_jsonl(s, _written(s, "jsonl", lambda p: files.write_jsonl(_raw(s, d).select("seq", "text_raw", "aksharantar_score", "category"), p)), "seq bigint, text_raw string, aksharantar_score double, category string", strict=True),
        "tolerant_files": _tolerant,
        "appended_files": _appended,
        "snapshot_files": lambda s, d: s.read.parquet(_written(s, "snapshot", lambda p: files.write_snapshot(_raw(s, d), p))).groupBy("source_name").agg(F.count(F.lit(1)).alias("n"), F.sum("seq").alias("seqs")),
        "routed_files": lambda s, d: s.read.parquet(_written(s, "routed", lambda p: files.write_routed(curate.score(_pairs(s, d)).transform(lambda x: x.withColumn("route", curate.route(x))), p, "route"))).groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.sum("seq").alias("seqs")),
        "split_files": lambda s, d: s.read.parquet(_written(s, "split", lambda p: files.write_routed(curate.split(_pairs(s, d).drop("split")), p, "split"))).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("seq").alias("seqs")),
        "manifest_file": _manifest,
        "lexicon_lines": lambda s, d: files.lexicon_records(_pairs(s, d).select(F.col("seq").alias("line"), F.concat_ws("\t", "telugu_text", "roman_text", F.lit(" "), F.lit("#x")).alias("value")), "t").select("source_doc_id", "text_raw", "script_hint", "row_hash"),
        "word_pair_lines": lambda s, d: files.pair_records(_pairs(s, d).select(F.lit("train").alias("split"), F.col("seq").alias("line"), F.to_json(F.struct(F.col("telugu_text").alias("native word"), F.col("roman_text").alias("english word"), F.when(F.col("seq") % 2 == 0, F.col("seq").cast("string")).alias("unique_identifier"), F.col("quality_score").alias("score"))).alias("value")), "t").select("source_doc_id", "text_raw", "script_hint", "paired_with", "aksharantar_source", "aksharantar_score"),
        "table_files": _tabbed,
        "ordered_files": _ordered,
        "encoded_pairs": lambda s, d: tokens.encoded(_pairs(s, d)).select("seq", F.array_join("input_ids", " ").alias("input_ids"), F.array_join("attention_mask", "").alias("attention_mask"), F.array_join("labels", " ").alias("labels"), "cut"),
        "encoded_reverse": lambda s, d: tokens.encoded(_pairs(s, d), "telugu_text", "roman_text", 256, 64).select("seq", F.array_join("input_ids", " ").alias("input_ids"), F.array_join("labels", " ").alias("labels"), "cut"),
    }


_SP = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_TE = r"[^\x{0C00}-\x{0C7F}]"


def _n(t: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(nfc_normalize(coalesce({t}, '')), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'), '{_SP}+', ' ', 'g'))"


def _strip(t: str) -> str:
    return f"regexp_replace({t}, '^{_SP}+|{_SP}+$', '', 'g')"


def _share(t: str, other: str = _TE) -> str:
    return f"CASE WHEN length({t}) > 0 THEN length(regexp_replace({t}, '{other}', '', 'g')) / length({t}) ELSE 0.0 END"


# Fixed values, apart from those of the engine: the Telugu letters in ITRANS, and in Velthuis where it differs.
_ITRANS = (
    "అ a ఆ A ఇ i ఈ I ఉ u ఊ U ఋ RRi ౠ RRI ఎ è ఏ e ఐ ai ఒ ò ఓ o ఔ au ా A ి i ీ I ు u ూ U ృ RRi ౄ RRI ె è ే e ై ai ొ ò ో o ౌ au "
    "క k ఖ kh గ g ఘ gh ఙ ~N చ ch ఛ Ch జ j ఝ jh ఞ ~n ట T ఠ Th డ D ఢ Dh ణ N త t థ th ద d ధ dh న n ప p ఫ ph బ b భ bh మ m య y ర r ల l వ v శ sh ష Sh స s హ h ళ L ఱ R "
    "ం M ః H ఁ .N ఽ .a ౦ 0 ౧ 1 ౨ 2 ౩ 3 ౪ 4 ౫ 5 ౬ 6 ౭ 7 ౮ 8 ౯ 9"
)
_VELTHUIS = "ఆ aa ా aa ఈ ii ీ ii ఊ uu ూ uu ఋ .r ృ .r ౠ .rr ౄ .rr ఙ \"n చ c ఛ ch ట .t ఠ .th డ .d ఢ .dh ణ .n శ \"s ష .s ళ .l ఱ r2 ం .m ః .h ఁ /"


def _roman(t: str, normalise: bool = True, velthuis: bool = False) -> str:
    words = (_ITRANS + (" " + _VELTHUIS if velthuis else "")).split(" ")
    spelled = dict(zip(words[::2], words[1::2])) | {"్": ""}
    m = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in spelled.items()) + "}"
    chars = f"regexp_extract_all(replace({t}, 'ై', 'ై'), '(?s).')"
    out = f"array_to_string([coalesce({m}[x.c], x.c) || CASE WHEN x.c BETWEEN 'క' AND 'హ' AND NOT coalesce(x.d BETWEEN 'ా' AND '్', false) THEN 'a' ELSE '' END FOR x IN list_transform(range(1, len({chars}) + 1), lambda i: {{'c': ({chars})[i], 'd': ({chars})[i + 1]}})], '')"
    if velthuis:
        return rf"trim(regexp_replace(lower({out}), '{_SP}+', ' ', 'g'))"
    if normalise:
        out = f"nfc_normalize({out})"
    for a, b in ("Aa", "Ii", "Uu", "èe", "òo", "Mm", "Hh", ("~", "")):
        out = f"replace({out}, '{a}', '{b}')"
    return rf"lower(trim(regexp_replace({out}, '{_SP}+', ' ', 'g')))"


_BYTES = "array_to_string(list_transform(range(1, 128), lambda i: chr(i::INTEGER)), '')"


def _edits(a: str, b: str) -> str:
    """Code-point edit distance: the characters of both texts become single bytes."""
    d = f"list_distinct(regexp_extract_all({a} || {b}, '(?s).'))"
    return f"levenshtein(translate({a}, array_to_string({d}, ''), substr({_BYTES}, 1, len({d}))), translate({b}, array_to_string({d}, ''), substr({_BYTES}, 1, len({d}))))"


def _word_edits(a: str, b: str) -> str:
    w = lambda t: f"list_filter(regexp_split_to_array({t}, '{_SP}+'), lambda x: x <> '')"
    d = f"list_distinct(list_concat({w(a)}, {w(b)}))"
    code = lambda t: f"array_to_string(list_transform({w(t)}, lambda x: chr(list_position({d}, x)::INTEGER)), '')"
    return f"levenshtein({code(a)}, {code(b)})"


_NORM = f"""
WITH n AS (SELECT *, {_n('text_raw')} AS text_normalized FROM raw_records),
m AS (SELECT *, {_share('text_normalized')} AS share, {_share('text_normalized', '[^A-Za-z]')} AS ascii FROM n),
norm AS (SELECT *, CASE WHEN share >= 0.4 THEN 'telugu' WHEN ascii >= 0.4 THEN 'roman' ELSE 'mixed' END AS script_detected,
  CASE WHEN text_normalized = '' THEN 'empty_after_normalize' WHEN script_hint = 'telugu' AND share < 0.1 THEN 'telugu_hint_no_script' END AS drop_reason FROM m)
"""


def _junk(t: str) -> str:
    digit = text.DIGIT
    chars = f"regexp_extract_all({t}, '(?s).')"
    return rf"""CASE WHEN length({_strip(t)}) < 2 THEN 'too_short' WHEN length({t}) > 512 THEN 'too_long'
  WHEN regexp_matches({_strip(t)}, '(?i)^(https?://|www\.)\S+$') THEN 'url_only'
  WHEN {_strip(f"regexp_replace({t}, '[' || chr(127744) || '-' || chr(129791) || chr(9728) || '-' || chr(10175) || ']+', '', 'g')")} = '' THEN 'emoji_only'
  WHEN (length({t}) - length(regexp_replace({t}, '{digit}', '', 'g'))) / length({t}) > 0.6 THEN 'high_digit_ratio'
  WHEN length({t}) >= 4 AND list_max([len(list_filter({chars}, lambda y: y = c)) FOR c IN list_distinct({chars})]) / length({t}) > 0.6 THEN 'high_repeat' END"""


_CLEAN = _NORM + f""", jt AS (SELECT *, coalesce(nullif(text_normalized, ''), text_raw, '') AS t FROM norm), j AS (SELECT *, {_junk('t')} AS junk_reason FROM jt), clean AS (SELECT * FROM j WHERE drop_reason IS NULL AND junk_reason IS NULL)"""
_OK = "(length({te}) > 0 AND length({ro}) / length({te}) BETWEEN 0.3 AND 4.0)"


def _eval_sql() -> str:
    return f"""
WITH e0 AS (SELECT seq, split, lower(trim(source_name)) AS source_name, pair_source, telugu_text AS roman_text, roman_text AS ref, {_roman('telugu_text')} AS pred FROM translit_pairs WHERE split IN ('val', 'test') AND roman_text IS NOT NULL),
e AS (SELECT *, {_edits('pred', 'ref')} AS edits, length(ref) AS chars, CASE WHEN ref = '' THEN CASE WHEN pred = '' THEN 0.0 ELSE 1.0 END ELSE {_edits('pred', 'ref')} / length(ref) END AS cer,
  {_word_edits('pred', 'ref')} AS wedits, len(list_filter(regexp_split_to_array(ref, '{_SP}+'), lambda x: x <> '')) AS words, {_strip('pred')} = {_strip('ref')} AS exact FROM e0)"""


_SLICES = """, s AS (SELECT 'overall' AS slice, * FROM e UNION ALL SELECT 'formal', * FROM e WHERE source_name = 'dakshina' AND pair_source = 'direct'
  UNION ALL SELECT 'colloquial', * FROM e WHERE source_name IN ('dakshina', 'aksharantar') AND pair_source = 'augmented' UNION ALL SELECT 'long_sentence', * FROM e WHERE source_name = 'wikipedia_te' AND pair_source = 'synthetic' AND length(roman_text) >= 30),
g AS (SELECT slice, count(*) AS n, round(avg(cer), 4) AS cer, round(sum(wedits) / sum(words), 4) AS wer, round(avg(exact::DOUBLE), 4) AS exact_match FROM s GROUP BY 1),
r AS (SELECT v.slice, coalesce(g.n, 0)::BIGINT AS n, cer, wer, exact_match FROM (VALUES ('overall'), ('formal'), ('colloquial'), ('long_sentence')) v(slice) LEFT JOIN g USING (slice))"""


def _word_variants_sql() -> str:
    subs = "MAP {" + ", ".join(f"'{k}': [{', '.join(repr(x) for x in v[: rules.TRIED])}]" for k, v in rules.WORD_SUBS.items()) + "}"
    return f"""WITH w AS (SELECT seq, roman_text AS t, list_filter(regexp_split_to_array(roman_text, '{_SP}+'), lambda x: x <> '') AS w FROM translit_pairs WHERE roman_text IS NOT NULL),
v AS (SELECT seq, t, flatten(list_transform(range(1, len(w) + 1), lambda i: list_transform(coalesce({subs}[lower(w[i])], []), lambda s: array_to_string(w[:i - 1] || [s] || w[i + 1:], ' ')))) AS v FROM w),
f AS (SELECT seq, list_filter(v, lambda x: x <> t) AS v FROM v)
SELECT seq, unnest(range(0, len(v)))::INTEGER AS at, unnest(v) AS variant FROM f"""


def _variants(rows: str) -> str:
    """CTEs that give v(seq, variants) for a relation of (seq, t), by a recursion over the rules; look-behinds become groups, since DuckDB has none."""
    groups = lambda p: p.replace("(?<![a-z])", "(^|[^a-z])").replace("(?<=[aeiou])", "([aeiou])")
    repl = lambda p, r: (r"\1" if "(?<" in p else "") + r
    subs = "MAP {" + ", ".join(f"'{k}': [{', '.join(repr(x) for x in v[: rules.TRIED])}]" for k, v in rules.WORD_SUBS.items()) + "}"
    words = f"flatten(list_transform(range(1, len(w) + 1), lambda i: list_transform(coalesce({subs}[lower(w[i])], []), lambda s: array_to_string(w[:i - 1] || [s] || w[i + 1:], ' '))))"
    entry = lambda p, rs: "[" + ", ".join(f"regexp_replace(t, '{groups(p)}', '{repl(p, r)}')" for r in rs[: rules.TRIED]) + "]"
    tiers = [[entry(p, rs) for p, rs in rules.TIER1], [entry(p, rs) for p, rs in rules.TIER2], [words], [entry(p, rs) for p, rs in rules.TIER3]]
    number = [k for k, tier in enumerate(tiers, 1) for _ in tier]
    clean = lambda x: f"list_transform(list_filter({x}, lambda v: v <> t AND {_strip('v')} <> ''), lambda v: {_strip('v')})"
    lists = ", ".join(clean(x) for tier in tiers for x in tier)
    return rf"""vr AS ({rows}), vw AS (SELECT seq, t, list_filter(regexp_split_to_array(t, '\s+'), lambda x: x <> '') AS w FROM vr), ve AS MATERIALIZED (SELECT seq, t, [{lists}] AS e FROM vw),
vx AS (SELECT seq, 0 AS i, 0 AS tier, []::VARCHAR[] AS seen, 0::BIGINT AS room, 0::BIGINT AS made FROM ve
  UNION ALL SELECT seq, i + 1, nt, CASE WHEN now_made < now_room THEN seen || list_filter(f, lambda v: NOT list_contains(seen, v)) ELSE seen END, now_room, now_made + CASE WHEN now_made < now_room THEN n ELSE 0 END
  FROM (SELECT *, CASE WHEN nt <> tier THEN 5 - len(seen) ELSE room END AS now_room, CASE WHEN nt <> tier THEN 0 ELSE made END AS now_made FROM (SELECT vx.*, {number}[vx.i + 1] AS nt, len(ve.e[vx.i + 1]) AS n, list_filter(ve.e[vx.i + 1], lambda v, k: v <> ve.t AND list_position(ve.e[vx.i + 1], v) = k) AS f FROM vx JOIN ve USING (seq) WHERE vx.i < {len(number)}))),
v AS (SELECT seq, seen[:5] AS variants FROM vx WHERE i = {len(number)})"""


def _telugu(t: str) -> list[str]:
    """Roman to Telugu by each of the three schemes, as expressions over a text."""
    clean = rf"trim(regexp_replace(nfc_normalize(coalesce({t}, '')), '{_SP}+', ' ', 'g'))"
    quoted = lambda x: x.replace("'", "''")
    literal = lambda m: "MAP {" + ", ".join(f"'{quoted(k)}': '{quoted(v)}'" for k, v in m.items()) + "}"
    out = []
    for free, sign, cons, rest in translit.SCHEMES:
        keys = sorted({*free, *cons, *rest}, key=lambda k: (-len(k), k))
        pattern = "(?s)(?:" + "|".join("".join(c if c.isalnum() else f"\\{c}" for c in k) for k in keys) + "|.)"
        k = f"regexp_extract_all({clean}, '{quoted(pattern)}')"
        one = f"coalesce({literal(cons)}[x.t] || CASE WHEN {literal(free)}[x.z] IS NOT NULL THEN '' ELSE '్' END, CASE WHEN {literal(cons)}[x.b] IS NOT NULL THEN {literal(sign)}[x.t] ELSE {literal(free)}[x.t] END, {literal(rest)}[x.t], x.t)"
        spelled = f"array_to_string([{one} FOR x IN list_transform(range(1, len({k}) + 1), lambda i: {{'t': ({k})[i], 'b': CASE WHEN i > 1 THEN ({k})[i - 1] END, 'z': ({k})[i + 1]}})], '')"
        out.append(rf"trim(regexp_replace({spelled}, '{_SP}+', ' ', 'g'))")
    return out


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of each query that SQL can express over whole tables."""
    ev = _eval_sql()
    fail = ev + ", f AS (SELECT *, round(cer, 4) AS c4 FROM e), ff AS (SELECT * FROM f WHERE c4 >= 0.2)"
    key = f"sha256(lower({_strip('coalesce(telugu_text, chr(32))')}) || '|||' || lower({_strip('coalesce(roman_text, chr(32))')}))"
    skey = f"md5(lower({_strip('coalesce(telugu_text, chr(32))')}))"
    v = f"('0x' || substr({skey}, 1, 4))::INTEGER"
    split = f"CASE WHEN {v} <= 58981 THEN 'train' WHEN {v} <= 62258 THEN 'val' ELSE 'test' END"
    ro, te = "coalesce(roman_text, '')", "coalesce(telugu_text, '')"
    ratio = f"(CASE WHEN length({te}) > 0 THEN length({ro}) / length({te}) ELSE 0.0 END)"
    zero = f"CASE WHEN length({_strip(ro)}) < 2 THEN 'roman_too_short' WHEN length({_strip(te)}) < 1 THEN 'telugu_too_short' WHEN {_share(te)} < 0.1 THEN 'telugu_no_script' END"
    score = f"""WITH z AS (SELECT *, {zero} AS zero, {ratio} AS ratio, {_share(ro)} > 0.05 AS mixed FROM translit_pairs),
q AS (SELECT *, CASE WHEN zero IS NOT NULL THEN 0.0 ELSE greatest(0.0, least(1.0, round((1.0::DOUBLE - CASE WHEN NOT ratio BETWEEN 0.3 AND 4.0 THEN 0.4::DOUBLE ELSE 0.0 END - CASE WHEN mixed THEN 0.3::DOUBLE ELSE 0.0 END - CASE WHEN pair_source = 'augmented' THEN 0.05::DOUBLE ELSE 0.0 END) * 0.6::DOUBLE + coalesce(confidence, 0.75::DOUBLE) * 0.4::DOUBLE, 4))) END AS qs,
  CASE WHEN zero IS NOT NULL THEN zero ELSE array_to_string(list_filter([CASE WHEN NOT ratio BETWEEN 0.3 AND 4.0 THEN 'length_ratio_out_of_range:' || printf('%.2f', ratio) END, CASE WHEN mixed THEN 'roman_has_telugu_chars' END], lambda x: x IS NOT NULL), ',') END AS reasons FROM z)"""
    syn = rf"""CASE WHEN length(r) < 3 THEN 'roman too short' WHEN length(r) > 512 THEN 'roman too long' WHEN NOT regexp_matches(r, '[A-Za-z]') THEN 'roman has no ASCII letters'
  WHEN (length(r) - length(regexp_replace(r, '{text.DIGIT}', '', 'g'))) / length(r) > 0.5 THEN 'roman >50% digits' WHEN {_share('t')} < 0.10 THEN 'telugu density' WHEN NOT length(r) / greatest(length(t), 1) BETWEEN 0.30 AND 4.00 THEN 'length ratio' END"""
    llm = f"WITH l AS (SELECT *, {_strip(ro)} AS r, nfc_normalize({_strip(te)}) AS t FROM llm_pairs)"
    required = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in sorted(("source_name", "source_doc_id", "source_url", "license_tag", "pull_timestamp_utc", "text_raw", "script_hint", "lang_hint", "row_hash")))
    allowed = "('CC0', 'CC-BY-4.0', 'CC-BY-SA-4.0', 'Apache-2.0', 'MIT', 'internal', 'CC-BY-NC-4.0')"
    valid = f"""SELECT seq, CASE WHEN missing <> '' THEN 'Missing required fields: ' || missing WHEN license_tag NOT IN {allowed} THEN 'license_tag ''' || license_tag || ''' is not in approved tier'
  WHEN {_strip('text_raw')} = '' THEN 'text_raw must be a non-empty string' WHEN script_hint NOT IN ('roman', 'telugu', 'mixed') THEN 'script_hint ''' || script_hint || ''' must be one of mixed, roman, telugu' ELSE '' END AS reason
  FROM (SELECT *, array_to_string(list_filter([{required}], lambda x: x IS NOT NULL), ', ') AS missing FROM raw_records)"""
    mreq = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in sorted(("run_id", "source_name", "pull_timestamp_utc", "record_count", "output_file", "license_tag")))
    clause = lambda t: f"list_filter(list_transform(regexp_split_to_array({t}, '[,;।\\n]+'), lambda x: {_strip('x')}), lambda x: length(x) BETWEEN 15 AND 120)"
    conf = "CASE WHEN src IN ('Dakshina', 'Existing', 'Wikidata') THEN 0.9 WHEN src = 'Samanantar' THEN 0.85 WHEN sc IS NOT NULL AND NOT isnan(sc) THEN round(greatest(0.0, least(1.0, 1.0 + sc)), 4) ELSE 0.75 END"
    crossref = f"""c0 AS (SELECT * FROM clean WHERE source_name = 'aksharantar'), last AS (SELECT source_doc_id, max_by(text_normalized, seq) AS ro FROM c0 GROUP BY 1),
looks AS (SELECT source_doc_id, paired_with, min_by(text_normalized, seq) AS te, min_by({{'s': coalesce(aksharantar_source, ''), 'c': aksharantar_score}}, seq) AS x FROM c0 WHERE script_hint = 'telugu' AND paired_with <> '' GROUP BY 1, 2),
cr AS (SELECT last.ro AS roman_text, te AS telugu_text, x.s AS src, x.c AS sc FROM looks JOIN last ON last.source_doc_id = looks.paired_with),
cr2 AS (SELECT *, ({conf})::DOUBLE AS confidence FROM cr)"""
    lexicon = """d0 AS (SELECT *, string_split(source_doc_id, '_') AS p FROM clean WHERE source_name = 'dakshina'), d1 AS (SELECT *, p[3] AS line FROM d0 WHERE len(p) >= 4),
df AS (SELECT line, min_by(text_normalized, seq) AS telugu_text FROM d1 WHERE script_hint = 'telugu' GROUP BY 1), dx AS (SELECT text_normalized AS roman_text, telugu_text FROM d1 JOIN df USING (line) WHERE script_hint = 'roman')"""
    suffix = r"""s0 AS (SELECT *, regexp_extract(source_doc_id, '_(ro|te)$', 1) AS side, left(source_doc_id, length(source_doc_id) - 3) AS k FROM clean WHERE source_name = 'synthetic_gemma4'),
sx AS (SELECT k, max_by(text_normalized, seq) FILTER (side = 'ro') AS roman_text, max_by(text_normalized, seq) FILTER (side = 'te') AS telugu_text FROM s0 WHERE side <> '' GROUP BY 1 HAVING roman_text IS NOT NULL AND telugu_text IS NOT NULL)"""
    status = lambda extra="": f"CASE WHEN {_OK.format(te='telugu_text', ro='roman_text')}{extra} THEN 'approved' ELSE 'review' END"
    uid = r"^syn_.+?_([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})_(ro|te)$"
    uuid = f"""WITH u0 AS (SELECT *, regexp_extract(source_doc_id, '{uid}', 1) AS uid, regexp_extract(source_doc_id, '{uid}', 2) AS side FROM raw_records),
ro AS (SELECT uid, max_by({{'t': text_raw, 's': source_name, 'l': license_tag, 'p': pull_timestamp_utc}}, seq) AS r FROM u0 WHERE side = 'ro' GROUP BY 1), te AS (SELECT uid, max_by(text_raw, seq) AS telugu_text FROM u0 WHERE side = 'te' GROUP BY 1)
SELECT uid, r.t AS roman_text, telugu_text, coalesce(r.s, 'ollama_synthetic') AS source_name, coalesce(r.l, 'Apache-2.0') AS license_tag, coalesce(r.p, '') AS created_at FROM ro JOIN te USING (uid)"""
    pending = "coalesce(pair_source = 'wikipedia_pending', false)"
    drift_side = lambda n, t, src: f"""(SELECT count(*) AS {n}_count, coalesce(avg({_share(t)}) FILTER ({t} <> ''), 0.0) AS {n}_script, round(coalesce(avg(length({t})) FILTER ({t} <> ''), 0.0), 1) AS {n}_mean, coalesce(median(length({t})) FILTER ({t} <> ''), 0.0) AS {n}_median, coalesce(list_sort(list(length({t})) FILTER ({t} <> ''))[(floor((count(*) FILTER ({t} <> '')) * 0.95))::BIGINT + 1], 0) AS {n}_p95 FROM {src})"""
    v4 = f"{uuid.rsplit('SELECT uid', 1)[0].rstrip()}, u AS (SELECT row_number() OVER () AS seq, r.t AS roman_text, telugu_text, coalesce(r.s, 'ollama_synthetic') AS source_name FROM ro JOIN te USING (uid))"
    fit = "roman_text <> '' AND telugu_text <> '' AND review_status = 'approved' AND confidence >= 0.6"
    config = """, s AS (SELECT 'overall' AS slice, * FROM e UNION ALL SELECT 'english', * FROM e WHERE len(w0) > 0 AND len(list_filter(w0, lambda x: regexp_full_match(x, '[A-Za-z]{2,}'))) / len(w0) >= 0.2
  UNION ALL SELECT 'listed', * FROM e WHERE len(list_intersect(list_transform(w0, lambda x: regexp_replace(lower(x), '^[.,!?]+|[.,!?]+$', '', 'g')), ['bus', 'office', 'phone', 'time'])) > 0 UNION ALL SELECT 'short', * FROM e WHERE source_name = 'aksharantar' AND pair_source = 'direct' AND length(roman_text) >= 12),
g AS (SELECT slice, count(*) AS n, round(avg(cer), 4) AS cer, round(sum(wedits) / sum(words), 4) AS wer, round(avg(exact::DOUBLE), 4) AS exact_match FROM s GROUP BY 1),
r AS (SELECT v.slice, coalesce(g.n, 0)::BIGINT AS n, cer, wer, exact_match FROM (VALUES ('overall'), ('english'), ('listed'), ('short')) v(slice) LEFT JOIN g USING (slice))"""
    config = ev.replace("SELECT *, ", f"SELECT *, list_filter(regexp_split_to_array(roman_text, '{_SP}+'), lambda x: x <> '') AS w0, ", 1) + config
    flat = lambda c: rf"""regexp_replace({c}, '[\t\r\n"\\]', ' ', 'g')"""
    less = "round(((confidence * 0.9::DOUBLE)::VARCHAR)::DECIMAL(38, 20), 4)::DOUBLE"  # by the shortest decimal of the double, as Spark rounds
    schemes = _telugu("roman_text")
    curated = f"""{_CLEAN.replace("WITH", "WITH RECURSIVE", 1)}, {lexicon}, {crossref}, {suffix},
lx AS (SELECT line, min(seq) AS lo FROM d1 GROUP BY 1), ly AS (SELECT [lo, seq] AS o, text_normalized AS roman_text, telugu_text FROM d1 JOIN df USING (line) JOIN lx USING (line) WHERE script_hint = 'roman'),
cl AS (SELECT *, min(seq) OVER (PARTITION BY source_doc_id, paired_with) AS s1 FROM c0 WHERE script_hint = 'telugu' AND paired_with <> ''),
cx AS (SELECT [seq] AS o, ro AS roman_text, text_normalized AS telugu_text, coalesce(aksharantar_source, '') AS src, aksharantar_score AS sc FROM cl JOIN last ON last.source_doc_id = cl.paired_with WHERE seq = s1), cy AS (SELECT *, ({conf})::DOUBLE AS confidence FROM cx),
sy AS (SELECT [min(seq)] AS o, max_by(text_normalized, seq) FILTER (side = 'ro') AS roman_text, max_by(text_normalized, seq) FILTER (side = 'te') AS telugu_text FROM s0 WHERE side <> '' GROUP BY k HAVING roman_text IS NOT NULL AND telugu_text IS NOT NULL),
py AS (SELECT [seq] AS o, source_name, text_normalized AS telugu_text, {_roman('text_normalized')} AS roman_text FROM clean WHERE source_name IN ('wikipedia_te', 'samanantar') AND script_hint = 'telugu'),
made AS (SELECT o, 'dakshina' AS snapshot, 'dakshina' AS source_name, roman_text, telugu_text, 'direct' AS pair_source, 0.9::DOUBLE AS confidence, {status()} AS review_status FROM ly
  UNION ALL SELECT o, 'aksharantar', 'aksharantar', roman_text, telugu_text, 'direct', confidence, {status(' AND confidence >= 0.4')} FROM cy
  UNION ALL SELECT o, 'synthetic_gemma4', 'ollama_synthetic', roman_text, telugu_text, 'synthetic', 0.8, {status()} FROM sy
  UNION ALL SELECT o, source_name, source_name, roman_text, telugu_text, 'synthetic', 0.7, 'approved' FROM py WHERE telugu_text <> '' AND roman_text <> ''),
wp AS (SELECT *, {clause('telugu_text')} AS c FROM made WHERE source_name = 'wikipedia_te' AND {_share('telugu_text')} >= 0.3),
wc AS (SELECT o, snapshot, source_name, unnest(range(0, len(c2))) AS i, unnest(c2) AS telugu_text FROM (SELECT *, CASE WHEN len(c) > 0 THEN c WHEN length(telugu_text) BETWEEN 15 AND 120 THEN [telugu_text] ELSE [] END AS c2 FROM wp)),
better AS (SELECT * FROM made WHERE source_name <> 'wikipedia_te' UNION ALL SELECT o || [0, i], snapshot, source_name, roman_text, telugu_text, 'synthetic', 0.65, 'approved' FROM (SELECT *, {_roman('telugu_text', False)} AS roman_text FROM wc) WHERE roman_text <> ''),
bn AS MATERIALIZED (SELECT *, row_number() OVER () AS seq FROM better), {_variants(f'SELECT seq, roman_text AS t FROM bn WHERE {fit}')},
every AS (SELECT o, snapshot, source_name, roman_text, telugu_text, pair_source, confidence FROM bn UNION ALL SELECT o || [-1, i], snapshot, source_name, variant, telugu_text, 'augmented', {less} FROM (SELECT seq, unnest(range(0, len(variants))) AS i, unnest(variants) AS variant FROM v) JOIN bn USING (seq)),
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY snapshot, {key} ORDER BY o) AS nth FROM every) WHERE nth = 1), {score.replace("FROM translit_pairs", "FROM once").removeprefix("WITH ")}
"""
    share = lambda x: _share(x)
    chars = lambda t: f"regexp_extract_all({t}, '(?s).')"
    ids = lambda t, n: f"list_transform(regexp_extract_all(hex(encode(coalesce({t}, '')))[:{2 * (n - 1)}], '..'), lambda x: ('0x' || x)::INTEGER + 3) || [1]"
    filled = lambda t, n, v: f"array_to_string({ids(t, n)} || list_transform(range(0, {n} - len({ids(t, n)})), lambda x: {v}), ' ')"
    cut = lambda a, n, b, m: f"octet_length(encode(coalesce({a}, ''))) >= {n} OR octet_length(encode(coalesce({b}, ''))) >= {m} AS cut"
    return {
        "rule_transliterate": f"WITH z AS (SELECT seq, coalesce(roman_text, '') AS t, {schemes[0]} AS a, {schemes[1]} AS b, {schemes[2]} AS c FROM translit_pairs), y AS (SELECT *, {share('a')} AS x, {share('b')} AS y, {share('c')} AS z FROM z) SELECT seq, CASE WHEN greatest(x, y, z) = 0 THEN t WHEN x >= y AND x >= z THEN a WHEN y >= z THEN b ELSE c END AS telugu FROM y",
        "tier_variants": f"WITH RECURSIVE {_variants('SELECT seq, roman_text AS t FROM translit_pairs WHERE roman_text IS NOT NULL')} SELECT seq, unnest(range(0, len(variants)))::INTEGER AS at, unnest(variants) AS variant FROM v",
        "augment_pairs": f"WITH RECURSIVE {_variants(f'SELECT seq, roman_text AS t FROM translit_pairs WHERE {fit}')} SELECT pair_source, count(*) AS n, sum(round(confidence * 10000)::BIGINT)::BIGINT AS confidence FROM (SELECT pair_source, confidence FROM translit_pairs UNION ALL SELECT 'augmented', {less} FROM (SELECT seq, unnest(variants) FROM v) JOIN translit_pairs USING (seq)) GROUP BY 1",
        "append_generated": f"{v4.replace('WITH', 'WITH RECURSIVE', 1)}, {_variants('SELECT seq, roman_text AS t FROM u WHERE roman_text IS NOT NULL')} SELECT source_name, pair_source, count(*) AS n FROM (SELECT source_name, pair_source FROM translit_pairs WHERE split = 'train' UNION ALL SELECT source_name, 'synthetic' FROM u UNION ALL SELECT source_name, 'augmented' FROM (SELECT seq, unnest(variants) FROM v) JOIN u USING (seq)) GROUP BY 1, 2",
        "generated_leakage": f"{v4}, k AS (SELECT DISTINCT 'train' AS split, {skey} AS k FROM (SELECT telugu_text FROM translit_pairs WHERE split = 'train' UNION ALL SELECT telugu_text FROM u) UNION SELECT DISTINCT 'test', {skey} FROM translit_pairs WHERE split = 'test') SELECT x.split AS a, y.split AS b, count(*) AS n FROM k x JOIN k y ON x.k = y.k AND x.split < y.split GROUP BY 1, 2",
        "divergent": f"{ev}, d AS (SELECT seq, abs(CASE WHEN ref = '' THEN 0.0 ELSE {_edits('pred', 'ref')} / length(ref) END - CASE WHEN ref = '' THEN 0.0 ELSE {_edits('roman_text', 'ref')} / length(ref) END) AS gap FROM e0 WHERE roman_text IS NOT NULL) SELECT seq, round(gap, 6) AS gap FROM (SELECT * FROM d ORDER BY gap DESC, seq DESC LIMIT 10)",
        "confusion_chars": f"{fail}, c AS (SELECT seq, unnest(range(1, least(length(ref), length(pred)) + 1)) AS i, {chars('ref')} AS r, {chars('pred')} AS p FROM ff), x AS (SELECT seq, i, r[i] AS a, p[i] AS b FROM c WHERE r[i] <> p[i]) SELECT a || '→' || b AS pattern, count(*) AS count FROM x WHERE a BETWEEN chr(3072) AND chr(3199) OR b BETWEEN chr(3072) AND chr(3199) GROUP BY a, b ORDER BY count(*) DESC, min({{'s': seq, 'i': i}}) LIMIT 20",
        "sample_rows": rf"SELECT seq FROM translit_pairs WHERE length(roman_text) BETWEEN 8 AND 60 AND NOT regexp_matches(roman_text, '[0-9@#$%^&*()\[\]{{}}|\\<>]') AND length(regexp_replace(roman_text, '[^\p{{L}}]', '', 'g')) / length(roman_text) >= 0.7 ORDER BY md5('42|' || seq), seq LIMIT 50",
        "dedup_report": f"SELECT count(*) AS input_count, count(*) - count(DISTINCT {key}) AS exact_dupes, 0::BIGINT AS near_dupes, count(DISTINCT {key}) AS output_count FROM translit_pairs",
        "spelling_fixes": r"SELECT seq, regexp_replace(roman_text || 'ey oley', '(?i)([a-z])ey\b', '\1e', 'g') AS roman, telugu_text AS telugu FROM translit_pairs",
        "eval_configured": config + "SELECT slice, n AS count, cer, wer, exact_match FROM r",
        "eval_targets": config + "SELECT slice, cer, 0.5::DOUBLE AS cer_max, cer < 0.5 AS met FROM r WHERE slice = 'english'",
        "review_answers": "WITH a AS (SELECT seq, length(coalesce(roman_text, '')) % 4 AS k FROM translit_pairs WHERE review_status = 'review') SELECT seq, CASE k WHEN 0 THEN 0.75 WHEN 1 THEN 0.5 END::DOUBLE AS ollama_score, CASE k WHEN 0 THEN 'plausible' WHEN 1 THEN 'wrong_word' ELSE 'empty_response' END AS ollama_reason, k = 1 AS ollama_flag, CASE WHEN k < 2 THEN 'client' END AS ollama_model FROM a",
        "predictions": "SELECT seq, replace(coalesce(roman_text, ''), ' ', '_') AS prediction FROM translit_pairs",
        "union_sources": "SELECT pair_source, split, category, count(*) AS n FROM (SELECT pair_source, split, NULL AS category FROM translit_pairs UNION ALL SELECT pair_source, NULL, category FROM llm_pairs) GROUP BY 1, 2, 3",
        "scored_else_deduped": "SELECT seq FROM translit_pairs WHERE split IN ('val', 'test', 'train')",
        "shuffled_places": "SELECT seq, row_number() OVER (ORDER BY md5('42|' || seq), seq) - 1 AS place FROM translit_pairs",
        "dataset_card": "WITH c AS (SELECT coalesce(source_name, 'unknown') AS source_name, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test, count(*) AS total FROM translit_pairs GROUP BY 1) SELECT source_name, format('{:,}', train) AS train, format('{:,}', val) AS val, format('{:,}', test) AS test, format('{:,}', total) AS total FROM (SELECT * FROM c UNION ALL SELECT 'total', sum(train)::BIGINT, sum(val)::BIGINT, sum(test)::BIGINT, sum(total)::BIGINT FROM c)",
        "jsonl_files": "SELECT seq, text_raw, aksharantar_score, category FROM raw_records",
        "tolerant_files": "SELECT seq % 7 = 0 AS corrupt, count(*) AS n, sum(length(text_raw)) FILTER (seq % 7 <> 0)::BIGINT AS chars FROM raw_records WHERE seq % 7 = 0 OR seq % 5 <> 0 GROUP BY 1",
        "appended_files": "SELECT category, 2 * count(*) AS n FROM raw_records GROUP BY 1",
        "snapshot_files": "SELECT source_name, count(*) AS n, sum(seq)::BIGINT AS seqs FROM raw_records GROUP BY 1",
        "routed_files": score + "SELECT CASE WHEN qs = 0 THEN 'rejected' WHEN qs < 0.4 THEN 'review' ELSE 'approved' END AS route, count(*) AS n, sum(seq)::BIGINT AS seqs FROM q GROUP BY 1",
        "split_files": f"SELECT {split} AS split, count(*) AS n, sum(seq)::BIGINT AS seqs FROM translit_pairs WHERE review_status = 'approved' GROUP BY 1",
        "manifest_file": "SELECT 'r' AS run_id, count(*) AS record_count, 1::BIGINT AS food FROM raw_records",
        "lexicon_lines": rf"WITH l AS (SELECT seq, concat_ws(chr(9), telugu_text, roman_text, ' ', '#x') AS value FROM translit_pairs), c AS (SELECT seq, list_transform(string_split(value, chr(9)), lambda x: {_strip('x')}) AS c FROM l WHERE value NOT LIKE '#%'), u AS (SELECT seq, unnest(range(0, len(c))) AS i, unnest(c) AS t FROM c WHERE c[1] <> '') SELECT 'te_lex_' || seq || '_' || i AS source_doc_id, t AS text_raw, CASE WHEN i = 0 THEN 'telugu' ELSE 'roman' END AS script_hint, sha256(t) AS row_hash FROM u WHERE t <> ''",
        "word_pair_lines": f"WITH p AS (SELECT 'train_' || CASE WHEN seq % 2 = 0 THEN seq::VARCHAR ELSE 'line' || seq END AS id, {_strip('telugu_text')} AS te, {_strip('roman_text')} AS ro, quality_score AS q FROM translit_pairs) SELECT id || '_te' AS source_doc_id, te AS text_raw, 'telugu' AS script_hint, id || '_ro' AS paired_with, 'unknown' AS aksharantar_source, q AS aksharantar_score FROM p WHERE te <> '' AND ro <> '' UNION ALL SELECT id || '_ro', ro, 'roman', id || '_te', 'unknown', q FROM p WHERE te <> '' AND ro <> ''",
        "table_files": f"WITH p AS (SELECT seq, {_strip(flat('roman_text'))} AS ro, {_strip(flat('telugu_text'))} AS te FROM translit_pairs) SELECT seq::VARCHAR AS source_doc_id, ro AS text_raw, 'roman' AS script_hint, sha256(ro) AS row_hash FROM p WHERE ro <> '' AND te <> '' UNION ALL SELECT seq::VARCHAR, te, 'telugu', sha256(te) FROM p WHERE ro <> '' AND te <> ''",
        "ordered_files": "SELECT row_number() OVER (ORDER BY seq) - 1 AS seq, seq::VARCHAR AS value FROM translit_pairs",
        "curated_exact": curated + "SELECT snapshot, source_name, telugu_text, roman_text, pair_source, qs AS quality_score, CASE WHEN qs < 0.4 THEN 'review' ELSE 'approved' END AS review_status, reasons FROM q",
        "encoded_pairs": f"SELECT seq, {filled('roman_text', 128, 0)} AS input_ids, rpad(repeat('1', len({ids('roman_text', 128)})), 128, '0') AS attention_mask, {filled('telugu_text', 128, -100)} AS labels, {cut('roman_text', 128, 'telugu_text', 128)} FROM translit_pairs",
        "encoded_reverse": f"SELECT seq, {filled('telugu_text', 256, 0)} AS input_ids, {filled('roman_text', 64, -100)} AS labels, {cut('telugu_text', 256, 'roman_text', 64)} FROM translit_pairs",
        "normalize_records": _NORM + "SELECT seq, text_normalized, script_detected, drop_reason FROM norm",
        "normalize_reasons": _NORM + "SELECT drop_reason AS reason, count(*) AS n FROM norm WHERE drop_reason IS NOT NULL GROUP BY 1",
        "normalize_report": _NORM + "SELECT 'normalize' AS stage, count(*) AS input_count, count(*) FILTER (drop_reason IS NULL) AS output_count, count(drop_reason) AS drop_count FROM norm",
        "script_profile": _NORM + "SELECT source_name, script_detected, count(*) AS n, round(avg(share), 6) AS share FROM norm GROUP BY 1, 2",
        "row_hashes": "SELECT seq, sha256(text_raw) AS computed, sha256(text_raw) = row_hash AS same FROM raw_records",
        "junk_kept": _CLEAN + "SELECT seq, text_normalized FROM clean",
        "junk_rows": _CLEAN + "SELECT seq, junk_reason FROM j",
        "junk_document_lines": f"WITH l AS (SELECT unnest(string_split(text, chr(10))) AS t FROM documents WHERE text IS NOT NULL) SELECT {_junk('t')} AS junk_reason, count(*) AS n FROM l GROUP BY 1",
        "validate_records": f"SELECT seq, reason = '' AS passed, reason, CASE WHEN reason = '' THEN '' ELSE 'reject' END AS action FROM ({valid})",
        "validate_manifests": f"SELECT run_id, source_name, reason = '' AS passed, reason FROM (SELECT *, CASE WHEN missing <> '' THEN 'missing: ' || missing WHEN record_count < 0 THEN 'record_count is negative' WHEN license_tag NOT IN {allowed} THEN 'license_tag not allowed' ELSE '' END AS reason FROM (SELECT *, array_to_string(list_filter([{mreq}], lambda x: x IS NOT NULL), ', ') AS missing FROM pull_manifests))",
        "licence_tiers": "SELECT license_tag, CASE WHEN license_tag = 'CC-BY-NC-4.0' THEN 'B' WHEN license_tag IN ('no-ai-training', 'unknown') THEN 'C' WHEN license_tag IN ('CC0', 'CC-BY-4.0', 'CC-BY-SA-4.0', 'Apache-2.0', 'MIT', 'internal') THEN 'A' END AS tier, CASE WHEN license_tag IN ('CC0', 'CC-BY-4.0', 'CC-BY-SA-4.0', 'Apache-2.0', 'MIT', 'internal') THEN true WHEN license_tag IN ('CC-BY-NC-4.0', 'no-ai-training', 'unknown') THEN false END AS allows_training, count(*) AS n FROM translit_pairs GROUP BY 1, 2, 3",
        "lexicon_pairs": _CLEAN + f", {lexicon} SELECT roman_text, telugu_text, 0.9::DOUBLE AS quality_score, 0.9::DOUBLE AS confidence, {status()} AS review_status FROM dx",
        "crossref_pairs": _CLEAN + f", {crossref} SELECT roman_text, telugu_text, confidence AS quality_score, confidence, {status(' AND confidence >= 0.4')} AS review_status FROM cr2",
        "suffix_pairs": _CLEAN + f", {suffix} SELECT roman_text, telugu_text, 0.8::DOUBLE AS quality_score, 0.8::DOUBLE AS confidence, {status()} AS review_status FROM sx",
        "uuid_pairs": uuid,
        "pending_pairs": _CLEAN + "SELECT text_normalized AS telugu_text, source_name, license_tag, 'review' AS review_status FROM clean WHERE source_name IN ('wikipedia_te', 'samanantar') AND script_hint = 'telugu'",
        "pair_status_counts": _CLEAN + f", {lexicon}, {crossref}, {suffix} SELECT source_name, review_status, count(*) AS n FROM (SELECT 'dakshina' AS source_name, {status()} AS review_status FROM dx UNION ALL SELECT 'aksharantar', {status(' AND confidence >= 0.4')} FROM cr2 UNION ALL SELECT 'ollama_synthetic', {status()} FROM sx UNION ALL SELECT source_name, 'review' FROM clean WHERE source_name IN ('wikipedia_te', 'samanantar') AND script_hint = 'telugu') GROUP BY 1, 2",
        "snapshot_index": "WITH f AS (SELECT seq, row_hash, source_name, replace(left(pull_timestamp_utc, 10), '-', '') AS pull_date FROM raw_records), g AS (SELECT *, row_number() OVER (PARTITION BY source_name, pull_date ORDER BY seq) AS k FROM f) SELECT source_name || '_' || pull_date || '.jsonl' AS filename, source_name, pull_date, count(*) AS record_count, 0::BIGINT AS size_bytes, string_agg(row_hash, ',' ORDER BY seq) FILTER (k <= 5) AS row_hashes_sample FROM g GROUP BY 1, 2, 3",
        "fill_pending": f"SELECT seq, CASE WHEN {pending} THEN r ELSE roman_text END AS roman_text, CASE WHEN {pending} THEN 'synthetic' ELSE pair_source END AS pair_source, CASE WHEN {pending} THEN 0.7 ELSE quality_score END AS quality_score, CASE WHEN {pending} THEN 0.7 ELSE confidence END AS confidence, CASE WHEN {pending} THEN 'approved' ELSE review_status END AS review_status FROM (SELECT *, {_roman(te)} AS r FROM translit_pairs) WHERE NOT {pending} OR (r <> '' AND coalesce(telugu_text, '') <> '')",
        "romanize": f"SELECT seq, {_roman('telugu_text')} AS roman FROM translit_pairs",
        "romanize_variants": f"SELECT seq, CASE WHEN a = b THEN a ELSE a || '|' || b END AS variants FROM (SELECT seq, {_roman('telugu_text')} AS a, {_roman('telugu_text', velthuis=True)} AS b FROM translit_pairs)",
        "improve_pairs": f"WITH w AS (SELECT *, {clause('telugu_text')} AS c FROM translit_pairs WHERE source_name = 'wikipedia_te' AND {_share('telugu_text')} >= 0.3), x AS (SELECT seq, unnest(CASE WHEN len(c) > 0 THEN c WHEN length(telugu_text) BETWEEN 15 AND 120 THEN [telugu_text] ELSE [] END) AS telugu_text FROM w), y AS (SELECT seq, telugu_text, {_roman('telugu_text', False)} AS roman_text FROM x) SELECT seq, telugu_text, roman_text, 'synthetic' AS pair_source, 0.65::DOUBLE AS quality_score FROM y WHERE roman_text <> '' UNION ALL SELECT seq, telugu_text, roman_text, pair_source, quality_score FROM translit_pairs WHERE source_name IS DISTINCT FROM 'wikipedia_te'",
        "clause_split": f"SELECT doc_id, unnest(range(0, len(c)))::INTEGER AS at, unnest(c) AS clause FROM (SELECT doc_id, {clause('text')} AS c FROM documents)",
        "article_sentences": f"WITH p AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[\\n।]+'), lambda x: {_strip('x')}), lambda x: length(x) BETWEEN 20 AND 400 AND {_share('x')} >= 0.4) AS c FROM documents), u AS (SELECT doc_id, unnest(range(0, len(c))) AS i, unnest(c) AS t FROM p) SELECT 'wiki_' || doc_id || '_s' || i AS source_doc_id, t AS text_raw, sha256(t) AS row_hash FROM u",
        "parallel_rows": f"WITH p AS (SELECT doc_id, {_strip('text')} AS t FROM documents) SELECT 'sam_te_' || (row_number() OVER (ORDER BY doc_id) - 1) AS source_doc_id, t AS text_raw FROM p WHERE length(t) BETWEEN 15 AND 300 AND {_share('t')} >= 0.3 ORDER BY doc_id LIMIT 300000",
        "exact_dedup": f"SELECT min(seq) AS seq FROM translit_pairs GROUP BY {key}",
        "score_pairs": score + "SELECT seq, qs AS quality_score, CASE WHEN qs < 0.4 THEN 'review' ELSE 'approved' END AS review_status, reasons FROM q",
        "route_counts": score + "SELECT CASE WHEN qs = 0 THEN 'rejected' WHEN qs < 0.4 THEN 'review' ELSE 'approved' END AS route, count(*) AS n FROM q GROUP BY 1",
        "split_rows": f"SELECT seq, {split} AS split FROM translit_pairs WHERE review_status = 'approved'",
        "split_counts": f"SELECT {split} AS split, count(*) AS n FROM translit_pairs WHERE review_status = 'approved' GROUP BY 1",
        "split_leakage": f"WITH k AS (SELECT DISTINCT split, {skey} AS k FROM translit_pairs WHERE split IS NOT NULL) SELECT x.split AS a, y.split AS b, count(*) AS n FROM k x JOIN k y ON x.k = y.k AND x.split < y.split GROUP BY 1, 2",
        "drift": f"SELECT new_count, round(new_script, 4) AS new_script, new_mean, new_median, new_p95, ref_count, round(ref_script, 4) AS ref_script, ref_mean, ref_median, ref_p95, round(abs(new_script - ref_script), 4) AS script_share_delta, round(abs(new_mean - ref_mean) / greatest(ref_mean, 1), 4) AS length_delta, array_to_string(list_filter([CASE WHEN abs(new_script - ref_script) > 0.05 THEN 'script_ratio' END, CASE WHEN abs(new_mean - ref_mean) / greatest(ref_mean, 1) > 0.2 THEN 'mean_length' END], lambda x: x IS NOT NULL), ',') AS alerts, CASE WHEN abs(new_script - ref_script) > 0.05 OR abs(new_mean - ref_mean) / greatest(ref_mean, 1) > 0.2 THEN 'DRIFT_DETECTED' ELSE 'OK' END AS status FROM {drift_side('new', 'text_raw', 'raw_records')}, {drift_side('ref', 'telugu_text', 'translit_pairs')}",
        "synthetic_refused": f"{llm} SELECT {syn} AS reason, count(*) AS n FROM l GROUP BY 1",
        "generated_accepted": f"{llm} SELECT DISTINCT r AS roman_text, sha256(r) AS row_hash FROM l WHERE ({syn}) IS NULL AND sha256(r) NOT IN (SELECT row_hash FROM raw_records)",
        "generated_trace": f"{llm} SELECT 1::BIGINT AS parsed, (CASE WHEN ({syn}) IS NULL THEN 1 ELSE 0 END)::BIGINT AS accepted, count(*) AS n FROM l GROUP BY 1, 2",
        "word_variants": _word_variants_sql(),
        "eval_compare": f"""WITH b AS (SELECT slice, cer AS baseline_cer FROM ({ev.replace("split IN ('val', 'test')", "split = 'val'")}{_SLICES}SELECT * FROM r)), c AS (SELECT slice, cer AS new_cer FROM ({ev.replace("split IN ('val', 'test')", "split = 'test'")}{_SLICES}SELECT * FROM r))
SELECT slice, baseline_cer, new_cer, new_cer - baseline_cer AS delta, CASE WHEN baseline_cer > 0 THEN (new_cer - baseline_cer) / baseline_cer * 100 WHEN new_cer - baseline_cer IS NOT NULL THEN 0.0 END AS pct,
  CASE WHEN new_cer - baseline_cer < -0.002 THEN 'BETTER' WHEN new_cer - baseline_cer > 0.002 THEN 'WORSE' WHEN new_cer - baseline_cer IS NOT NULL THEN 'same' END AS status FROM b FULL JOIN c USING (slice)""",
        "category_counts": "SELECT coalesce(category, 'unknown') AS category, count(*) AS n FROM raw_records WHERE script_hint = 'roman' GROUP BY 1",
        "seen_filter": "SELECT min(seq) AS seq, sha256(roman_text) AS row_hash FROM translit_pairs WHERE roman_text IS NOT NULL AND sha256(roman_text) NOT IN (SELECT row_hash FROM raw_records) GROUP BY 2",
        "review_scores": "SELECT seq, NULL::DOUBLE AS ollama_score, 'ollama_unavailable' AS ollama_reason, false AS ollama_flag FROM translit_pairs WHERE review_status = 'review' ORDER BY seq LIMIT 500",
        "eval_overall": ev + "SELECT count(*) AS count, round(avg(cer), 4) AS cer, round(sum(wedits) / sum(words), 4) AS wer, round(avg(exact::DOUBLE), 4) AS exact_match FROM e",
        "eval_slices": ev + _SLICES + "SELECT slice, n AS count, cer, wer, exact_match FROM r",
        "eval_micro": ev + "SELECT sum(CASE WHEN chars > 0 THEN edits ELSE 0 END) / greatest(sum(chars), 1) AS cer FROM e",
        "eval_acceptance": ev + _SLICES + "SELECT t.slice, r.cer, t.cer_max, r.cer < t.cer_max AS met FROM (VALUES ('colloquial', 0.10::DOUBLE), ('formal', 0.05::DOUBLE)) t(slice, cer_max) LEFT JOIN r USING (slice)",
        "eval_card": ev + _SLICES + "SELECT slice, n, coalesce(printf('%.2f', cer * 100) || '%', '—') AS cer_text, coalesce(printf('%.2f', wer * 100) || '%', '—') AS wer_text FROM r",
        "confusion_summary": fail + "SELECT count(*) AS sample_size, count(*) FILTER (c4 >= 0.2) AS failing_count, round(avg((c4 >= 0.2)::DOUBLE), 4) AS failing_rate, round(avg(c4), 4) AS overall_cer FROM f",
        "confusion_groups": fail + "SELECT section, key, count(*) AS count, round(avg(c4), 4) AS avg_cer FROM (SELECT 'by_source' AS section, coalesce(source_name, '') AS key, c4 FROM ff UNION ALL SELECT 'by_pair_source', coalesce(pair_source, ''), c4 FROM ff UNION ALL SELECT 'by_length', CASE WHEN length(roman_text) < 10 THEN 'short (<10)' WHEN length(roman_text) < 30 THEN 'medium (10-30)' WHEN length(roman_text) < 80 THEN 'long (30-80)' ELSE 'very_long (80+)' END, c4 FROM ff) GROUP BY 1, 2",
        "confusion_worst": fail + "SELECT seq, c4 AS cer FROM ff ORDER BY c4 DESC, seq LIMIT 20",
        "clean_prompts": r"SELECT seq FROM translit_pairs WHERE length(roman_text) BETWEEN 8 AND 60 AND NOT regexp_matches(roman_text, '[0-9@#$%^&*()\[\]{}|\\<>]') AND length(regexp_replace(roman_text, '[^\p{L}]', '', 'g')) / length(roman_text) >= 0.7",
    }
