"""Curation stages: each takes and gives a DataFrame and keeps columns that it does not know.

Order matters where "first" decides, and is always the order of a unique ``seq`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lekha.config import APPROVED_LICENCES, LICENCE_TIERS, MANIFEST_REQUIRED, REQUIRED_FIELDS, SCRIPT_HINTS, TELUGU, Junk, NearDup, Script, SplitCuts
from lekha.functions import rules, text, translit
from lekha.functions.minhash import with_bands
from lekha.operators.skew import join_group_values, salted_join


# ---- normalise and filter -------------------------------------------------------------------------------------------


def normalize(df: DataFrame, column: str = "text_raw", script: Script = TELUGU) -> DataFrame:
    """Adds text_normalized, script_detected and drop_reason (null for kept rows). A null text counts as empty."""
    t = text.normalized(F.coalesce(F.col(column), F.lit("")))
    out = df.withColumn("text_normalized", t).withColumn("script_detected", text.detect_script(F.col("text_normalized"), script))
    hint = F.col("script_hint") == "telugu" if "script_hint" in df.columns else F.lit(False)
    reason = F.when(F.col("text_normalized") == "", "empty_after_normalize").when(hint & (text.script_share(F.col("text_normalized"), script) < 0.1), "telugu_hint_no_script")
    return out.withColumn("drop_reason", reason)


def normalized_rows(df: DataFrame, **options) -> DataFrame:
    return normalize(df, **options).where("drop_reason is null").drop("drop_reason")


def junk(df: DataFrame, limits: Junk = Junk()) -> DataFrame:
    """Adds junk_reason; the text is text_normalized, or text_raw where that is empty or missing."""
    empty = lambda c: F.when(F.col(c) != "", F.col(c))
    return df.withColumn("junk_reason", text.junk_reason(F.coalesce(*[empty(c) for c in ("text_normalized", "text_raw") if c in df.columns]), limits))


def clean_rows(df: DataFrame, limits: Junk = Junk()) -> DataFrame:
    return junk(df, limits).where("junk_reason is null").drop("junk_reason")


def reason_counts(df: DataFrame, column: str) -> DataFrame:
    """(reason, n): rows by reason, without kept rows."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def stage_report(df: DataFrame, stage: str, column: str) -> DataFrame:
    """One row: stage, input_count, output_count, drop_count, drop_reasons (map), in one pass and one small second aggregation."""
    by = df.groupBy(F.col(column).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    dropped = F.when(F.col("reason").isNotNull(), F.struct("reason", "n"))
    return by.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("input_count"), F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col("n"))), F.lit(0)).alias("output_count"), F.coalesce(F.sum(F.when(F.col("reason").isNotNull(), F.col("n"))), F.lit(0)).alias("drop_count"), F.map_from_entries(F.collect_list(dropped)).alias("drop_reasons")).select(F.lit(stage).alias("stage"), "*")


# ---- governance -----------------------------------------------------------------------------------------------------


def validate_records(df: DataFrame) -> DataFrame:
    """Adds passed, reason, action: missing fields, licence, text, script hint; the first failure counts. A missing column is a missing field."""
    missing = F.array_sort(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) if c in df.columns else F.lit(c) for c in REQUIRED_FIELDS])))
    col = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("string")
    reason = (
        F.when(F.size(missing) > 0, F.concat(F.lit("Missing required fields: "), F.array_join(missing, ", ")))
        .when(~col("license_tag").isin(*APPROVED_LICENCES), F.concat(F.lit("license_tag '"), col("license_tag"), F.lit("' is not in approved tier")))
        .when(text.strip(col("text_raw")) == "", "text_raw must be a non-empty string")
        .when(~col("script_hint").isin(*SCRIPT_HINTS), F.concat(F.lit("script_hint '"), col("script_hint"), F.lit("' must be one of "), F.lit(", ".join(sorted(SCRIPT_HINTS)))))
        .otherwise("")
    )
    return df.withColumn("reason", reason).withColumn("passed", F.col("reason") == "").withColumn("action", F.when(F.col("passed"), "").otherwise("reject"))


def validate_manifests(df: DataFrame) -> DataFrame:
    """Adds passed and reason: required fields present, record_count not negative, licence allowed, no unknown column filled."""
    known = {*MANIFEST_REQUIRED, "takedown_contact"}
    missing = F.array_sort(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) if c in df.columns else F.lit(c) for c in MANIFEST_REQUIRED])))
    extra = [c for c in df.columns if c not in known]
    more = F.array_sort(F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNotNull(), F.lit(c)) for c in extra]))) if extra else F.array().cast("array<string>")
    reason = (
        F.when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
        .when(F.size(more) > 0, F.concat(F.lit("additional: "), F.array_join(more, ", ")))
        .when(F.col("record_count") < 0, "record_count is negative")
        .when(~F.col("license_tag").isin(*APPROVED_LICENCES), "license_tag not allowed")
        .otherwise("")
    )
    return df.withColumn("reason", reason).withColumn("passed", F.col("reason") == "")


def licence_tiers(df: DataFrame) -> DataFrame:
    """Adds tier, allows_training, allows_redistribution, requires_attribution; tags outside the matrix have nulls. The matrix has a fixed size and is broadcast."""
    matrix = df.sparkSession.createDataFrame(list(LICENCE_TIERS), "license_tag string, tier string, allows_training boolean, allows_redistribution boolean, requires_attribution boolean")
    return df.join(F.broadcast(matrix), "license_tag", "left")


# ---- pair builders --------------------------------------------------------------------------------------------------

_PAIR = ["roman_text", "telugu_text", "source_name", "license_tag", "pair_source", "quality_score", "confidence", "review_status", "created_at", "augmentation_variant"]


#: Columns that builders add for the pipeline: the input rows of a pair in their order, and the snapshot they come from.
ORDER, SNAPSHOT = "pair_order", "snapshot"


def _pairs(df: DataFrame, roman: Column, telugu: Column, *, source: Column, licence: Column, kind: str, score: Column, confidence: Column | None = None, status: Column | None = None, created_at: str = "", key: Column, order: list[Column]) -> DataFrame:
    ok = text.length_ratio_ok(roman, telugu)
    out = df.select(
        F.sha2(F.concat_ws("|", F.lit(kind), source, key), 256).alias("pair_id"), roman.alias("roman_text"), telugu.alias("telugu_text"), source.alias("source_name"), licence.alias("license_tag"), F.lit(kind).alias("pair_source"),
        score.alias("quality_score"), (score if confidence is None else confidence).alias("confidence"), (F.when(ok, "approved").otherwise("review") if status is None else status).alias("review_status"), F.lit(created_at).alias("created_at"), F.lit(None).cast("string").alias("augmentation_variant"),
        F.array(*[o.cast("bigint") for o in order]).alias(ORDER), F.col(SNAPSHOT) if SNAPSHOT in df.columns else F.lit(None).cast("string").alias(SNAPSHOT),
    )
    return out


def _kept(df: DataFrame) -> list[str]:
    return [SNAPSHOT] if SNAPSHOT in df.columns else []


def lexicon_pairs(df: DataFrame, created_at: str = "") -> DataFrame:
    """Rows te_lex_{line}_{variant}: the first Telugu row of a line with every Roman row of it; lines without one side give none."""
    parts = F.split("source_doc_id", "_")
    rows = df.where(F.size(parts) >= 4).select(parts[2].alias("line"), "script_hint", F.col("text_normalized").alias("t"), "seq", *_kept(df))
    first = rows.groupBy("line").agg(F.min_by(F.when(F.col("script_hint") == "telugu", F.col("t")), F.when(F.col("script_hint") == "telugu", F.col("seq"))).alias("te"), F.min("seq").alias("at")).where("te is not null")
    both = rows.where("script_hint = 'roman'").join(first, "line")
    return _pairs(both, F.col("t"), F.col("te"), source=F.lit("dakshina"), licence=F.lit("CC-BY-SA-4.0"), kind="direct", score=F.lit(0.90), created_at=created_at, key=F.concat_ws("|", "line", "seq"), order=[F.col("at"), F.col("seq")])


def crossref_pairs(df: DataFrame, created_at: str = "") -> DataFrame:
    """Telugu rows with the row that ``paired_with`` names. Of repeated identifiers the last row is looked up; of repeated (identifier, partner) the first row looks."""
    last = df.groupBy(F.col("source_doc_id").alias("paired_with")).agg(F.max_by("text_normalized", "seq").alias("ro"))
    lookers = df.where("script_hint = 'telugu' and paired_with is not null and paired_with != ''").groupBy("source_doc_id", "paired_with").agg(F.min_by(F.struct("text_normalized", "aksharantar_source", "aksharantar_score", "seq", *_kept(df)), "seq").alias("x"))
    both = lookers.join(last, "paired_with").select("source_doc_id", "paired_with", "x.*", "ro")
    conf = text.source_confidence(F.coalesce("aksharantar_source", F.lit("")), F.col("aksharantar_score"))
    status = F.when(text.length_ratio_ok(F.col("ro"), F.col("text_normalized")) & (conf >= 0.4), "approved").otherwise("review")
    return _pairs(both, F.col("ro"), F.col("text_normalized"), source=F.lit("aksharantar"), licence=F.lit("CC-BY-4.0"), kind="direct", score=conf, status=status, created_at=created_at, key=F.concat_ws("|", "source_doc_id", "paired_with"), order=[F.col("seq")])


def suffix_pairs(df: DataFrame, created_at: str = "") -> DataFrame:
    """Rows {key}_ro and {key}_te: the last of each side; both are needed."""
    side = F.regexp_extract("source_doc_id", "_(ro|te)$", 1)
    keyed = df.where(side != "").select(F.expr("substring(source_doc_id, 1, char_length(source_doc_id) - 3)").alias("key"), side.alias("side"), F.col("text_normalized").alias("t"), "seq", *_kept(df))
    both = keyed.groupBy("key").agg(F.min("seq").alias("at"), *[F.min_by(c, "seq").alias(c) for c in _kept(df)], *[F.max_by(F.when(F.col("side") == s, F.col("t")), F.when(F.col("side") == s, F.col("seq"))).alias(s) for s in ("ro", "te")]).where("ro is not null and te is not null")
    return _pairs(both, F.col("ro"), F.col("te"), source=F.lit("ollama_synthetic"), licence=F.lit("internal"), kind="synthetic", score=F.lit(0.80), created_at=created_at, key=F.col("key"), order=[F.col("at")])


def uuid_pairs(df: DataFrame) -> DataFrame:
    """Rows syn_{set}_{uuid}_ro and _te, raw texts, by UUID over all files; the last of each side; fields come from the Roman row."""
    pattern = r"^syn_.+?_([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})_(ro|te)$"
    uid = F.regexp_extract("source_doc_id", pattern, 1)
    rows = df.where(uid != "").withColumn("uid", uid).withColumn("side", F.regexp_extract("source_doc_id", pattern, 2))
    ro = rows.where("side = 'ro'").groupBy("uid").agg(F.max_by(F.struct("text_raw", "source_name", "license_tag", "pull_timestamp_utc"), "seq").alias("r"))
    te = rows.where("side = 'te'").groupBy("uid").agg(F.max_by("text_raw", "seq").alias("telugu_text"))
    return ro.join(te, "uid").select("uid", F.col("r.text_raw").alias("roman_text"), "telugu_text", F.coalesce("r.source_name", F.lit("ollama_synthetic")).alias("source_name"), F.coalesce("r.license_tag", F.lit("Apache-2.0")).alias("license_tag"), F.coalesce("r.pull_timestamp_utc", F.lit("")).alias("created_at"))


def pending_pairs(df: DataFrame, created_at: str = "") -> DataFrame:
    """Telugu rows as pairs that wait for their Roman side."""
    return _pairs(df.where("script_hint = 'telugu'"), F.lit(None).cast("string"), F.col("text_normalized"), source=F.coalesce("source_name", F.lit("wikipedia_te")), licence=F.coalesce("license_tag", F.lit("CC-BY-SA-3.0")), kind="wikipedia_pending", score=F.lit(0.0), status=F.lit("review"), created_at=created_at, key=F.col("seq").cast("string"), order=[F.col("seq")])


#: Builder of each source; other sources give no pairs.
BUILDERS = {"dakshina": lexicon_pairs, "aksharantar": crossref_pairs, "wikipedia_te": pending_pairs, "samanantar": pending_pairs, "ollama_synthetic": suffix_pairs, "synthetic_gemma4": suffix_pairs}


def build_pairs(df: DataFrame, created_at: str = "", source: str = "source_name") -> DataFrame:
    """Pairs of every source by its builder, as one DataFrame, with their order and snapshot (the source whose file they come from).

    The input is written once with the columns that builders need, so that its own stages
    (and their Unicode normalisation) run once and not for each builder.
    """
    from lekha.session import materialize

    needed = ["source_doc_id", "script_hint", "text_normalized", "seq", "paired_with", "aksharantar_source", "aksharantar_score", "source_name", "license_tag"]
    df = materialize(df.where(F.col(source).isin(*BUILDERS)).select(*dict.fromkeys([*(c for c in needed if c in df.columns), source]), F.col(source).alias(SNAPSHOT)), "builders")
    by: dict = {}
    for name, f in BUILDERS.items():
        by.setdefault(f, []).append(name)
    out = None
    for f, names in by.items():
        part = f(df.where(F.col(source).isin(*names)), created_at)
        out = part if out is None else out.unionByName(part)
    return out


# ---- romanise, improve, augment -------------------------------------------------------------------------------------


def fill_pending(df: DataFrame) -> DataFrame:
    """Pending pairs get a rule romanisation; those without Telugu or without result are dropped."""
    pending = F.col("pair_source") == "wikipedia_pending"
    roman = F.when(pending, translit.romanize(F.coalesce("telugu_text", F.lit("")))).otherwise(F.col("roman_text"))
    out = df.withColumn("_pending", F.coalesce(pending, F.lit(False))).withColumn("roman_text", roman)
    out = out.where(~F.col("_pending") | ((F.coalesce("telugu_text", F.lit("")) != "") & (F.col("roman_text") != "")))
    fix = {"pair_source": F.lit("synthetic"), "quality_score": F.lit(0.70), "confidence": F.lit(0.70), "review_status": F.lit("approved")}
    return out.withColumns({c: F.when(F.col("_pending"), v).otherwise(F.col(c)) for c, v in fix.items()}).drop("_pending")


def clauses(c: Column, least: int = 15, most: int = 120) -> Column:
    """Parts between commas, semicolons, dandas and line breaks, trimmed, of allowed length."""
    return F.filter(F.transform(F.split(c, r"[,;।\n]+"), text.strip), lambda x: F.char_length(x).between(least, most))


def improve_pairs(df: DataFrame, source: str = "wikipedia_te") -> DataFrame:
    """Pairs of one source become one pair per clause, newly romanised; mostly other scripts are dropped, other sources pass."""
    mine = F.coalesce(F.col("source_name") == source, F.lit(False))
    whole = F.when(F.char_length("telugu_text").between(15, 120), F.array("telugu_text")).otherwise(F.array().cast("array<string>"))
    parts = df.where(mine & text.is_mostly(F.coalesce("telugu_text", F.lit("")), 0.3)).withColumn("_c", clauses(F.col("telugu_text"))).withColumn("_c", F.when(F.size("_c") > 0, F.col("_c")).otherwise(whole))
    made = parts.select("*", F.posexplode("_c").alias("_i", "_t")).withColumn("telugu_text", F.col("_t"))
    if ORDER in df.columns:
        made = made.withColumn(ORDER, F.concat(ORDER, F.array(F.lit(0).cast("bigint"), F.col("_i").cast("bigint"))))
    made = made.drop("_c", "_i", "_t").withColumn("roman_text", translit.romanize(F.col("telugu_text"), normalise=False)).where("roman_text != ''")
    made = made.withColumns({"pair_source": F.lit("synthetic"), "quality_score": F.lit(0.65), "confidence": F.lit(0.65), "review_status": F.lit("approved")})
    return df.where(~mine).unionByName(made)


def with_variants(df: DataFrame, column: str = "roman_text", most: int = 5) -> DataFrame:
    """Adds variants, the spelling variants of a column (:func:`lekha.functions.rules.variants`); a null text has none."""
    return df.withColumn("variants", rules.variants(F.col(column), most))


def augment(df: DataFrame, most: int = 5) -> DataFrame:
    """Every pair, and for approved pairs of confidence 0.6 or more their spelling variants at 0.9 of the scores."""
    fit = (F.coalesce("roman_text", F.lit("")) != "") & (F.coalesce("telugu_text", F.lit("")) != "") & (F.col("review_status") == "approved") & (F.coalesce("confidence", F.lit(0.0)) >= 0.6)
    made = with_variants(df.where(fit), most=most).withColumn("augmentation_variant", F.col("roman_text")).select("*", F.posexplode("variants").alias("_i", "_variant"))
    less = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.7)) * 0.9, 4)
    made = made.withColumns({"pair_id": F.sha2(F.concat_ws("|", "pair_id", "_i"), 256), "roman_text": F.col("_variant"), "pair_source": F.lit("augmented"), "quality_score": less("quality_score"), "confidence": less("confidence")})
    if ORDER in df.columns:  # a variant comes after its original and before the next pair
        made = made.withColumn(ORDER, F.concat(ORDER, F.array(F.lit(-1).cast("bigint"), F.col("_i").cast("bigint"))))
    return df.unionByName(made.select(*df.columns))


def append_generated(train: DataFrame, generated: DataFrame, most: int = 5) -> DataFrame:
    """Train rows, then all generated pairs with constants and their variants; a variant row names itself. No deduplication and no new split."""
    base = generated.select("roman_text", "telugu_text", "source_name", "license_tag", "created_at")
    variants = with_variants(base, most=most).select("*", F.explode("variants").alias("_v"))
    fixed = {"quality_score": F.lit(0.85), "confidence": F.lit(0.85), "review_status": F.lit("approved")}
    a = base.withColumns({"pair_source": F.lit("synthetic"), "augmentation_variant": F.lit(None).cast("string")} | fixed)
    b = variants.withColumns({"roman_text": F.col("_v"), "pair_source": F.lit("augmented"), "augmentation_variant": F.col("_v")} | fixed).drop("_v", "variants")
    both = a.unionByName(b).withColumn("pair_id", F.sha2(F.concat_ws("|", "source_name", "telugu_text", "roman_text", "pair_source"), 256))
    return train.unionByName(both, allowMissingColumns=True)


# ---- distinct, score, split -----------------------------------------------------------------------------------------


def exact_dedup(df: DataFrame, order: str = "seq", by: list[str] = ()) -> DataFrame:
    """The first row of each pair key (within each value of the ``by`` columns). One scan and one shuffle: every map task passes on one row per key."""
    key = [text.pair_key(F.col("telugu_text"), F.col("roman_text")), *by]
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*key).orderBy(order))).where("_nth = 1").drop("_nth")


def near_dedup(df: DataFrame, order: str = "seq", column: str = "roman_text", near: NearDup = NearDup(), by: list[str] = ()) -> DataFrame:
    """Rows without an earlier kept row that shares a MinHash band (within each value of the ``by`` columns).

    Character shingles of the lower-case text; shorter texts are kept and hide nothing.
    A row is dropped when an earlier *kept* row collides, so a chain a~b~c keeps a and c.
    In each round a text that is the first of all its bands is kept and drops the others of
    those bands, until all are decided (the first of all undecided texts always is); no pairs
    are made, and bands of a third of all texts are split, for their smallest identifier and
    for who drops whom. Equal texts are reduced to their first row beforehand.
    """
    from lekha.session import discard, materialize

    if near.max_rows is not None and df.limit(near.max_rows + 1).count() > near.max_rows:
        return df
    within = F.concat_ws("\x1e", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1f")) for c in by])
    rows = df.select(F.col(order).alias("_id"), F.lower(text.strip(F.coalesce(F.col(column), F.lit("")))).alias("_t"), within.alias("_by"))
    long = rows.where(F.char_length("_t") >= near.shingle)
    texts = materialize(long.groupBy("_t", "_by").agg(F.min("_id").alias("_id")), "neartexts")
    bands = with_bands(texts, "_id", "_t", near.shingle, near.permutations, near.bands)
    if by:
        bands = bands.join(texts.select("_id", "_by"), "_id").withColumn("key", F.xxhash64("key", "_by")).drop("_by")
    bands = materialize(bands, "bands")
    dropped = []
    while total := bands.count():
        least = bands.groupBy("band", "key").agg(F.min("_id").alias("low"), F.count(F.lit(1)).alias("n"))
        seen = materialize(join_group_values(bands, least, ["band", "key"], "n", total).select("_id", "band", "key", "low"), "nearseen")
        kept = materialize(seen.groupBy("_id").agg(F.min(F.col("low") == F.col("_id")).alias("first")).where("first").select("_id"), "nearkept")
        decided = materialize(salted_join(seen.select("_id", "low"), kept.select(F.col("_id").alias("low")), ["low"]).select("_id").distinct(), "neardone")
        dropped.append(materialize(decided.join(kept, "_id", "left_anti"), "neardropped"))
        old, bands = bands, materialize(seen.join(decided, "_id", "left_anti").select("_id", "band", "key"), "bands")
        discard(old, seen, kept, decided)
    firsts = texts.select("_id")
    for gone in dropped:
        firsts = firsts.join(gone, "_id", "left_anti")
    kept_ids = firsts.unionByName(rows.where(F.char_length("_t") < near.shingle).select("_id"))
    return df.join(kept_ids.select(F.col("_id").alias(order)), order, "left_semi")


def dedup_report(df: DataFrame, near: NearDup | None = NearDup()) -> DataFrame:
    """(input_count, exact_dupes, near_dupes, output_count); without ``near`` only exact copies are counted."""
    once = exact_dedup(df)
    n, n1, n2 = df.agg(F.count(F.lit(1)).alias("a")), once.agg(F.count(F.lit(1)).alias("b")), (near_dedup(once, near=near) if near else once).agg(F.count(F.lit(1)).alias("c"))
    one = lambda d: d.withColumn("_k", F.lit(1))
    return one(n).join(one(n1), "_k").join(one(n2), "_k").select(F.col("a").alias("input_count"), (F.col("a") - F.col("b")).alias("exact_dupes"), (F.col("b") - F.col("c")).alias("near_dupes"), F.col("c").alias("output_count"))


def score(df: DataFrame) -> DataFrame:
    """Adds score_reasons and sets quality_score and review_status by rule; a null confidence counts as 0.75."""
    ro, te = F.coalesce("roman_text", F.lit("")), F.coalesce("telugu_text", F.lit(""))
    zero = F.when(F.char_length(text.strip(ro)) < 2, "roman_too_short").when(F.char_length(text.strip(te)) < 1, "telugu_too_short").when(text.script_share(te) < 0.1, "telugu_no_script")
    ratio = text.length_ratio(ro, te)
    off = ~ratio.between(0.3, 4.0)
    mixed = text.script_share(ro) > 0.05
    base = 1.0 - F.when(off, 0.4).otherwise(0.0) - F.when(mixed, 0.3).otherwise(0.0) - F.when(F.col("pair_source") == "augmented", 0.05).otherwise(0.0)
    value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(base * 0.6 + F.coalesce("confidence", F.lit(0.75)) * 0.4, 4)))
    out = df.withColumn("_zero", zero)
    reasons = F.when(F.col("_zero").isNotNull(), F.array("_zero")).otherwise(F.array_compact(F.array(F.when(off, F.concat(F.lit("length_ratio_out_of_range:"), F.replace(F.format_number(ratio, 2), F.lit(","), F.lit("")))), F.when(mixed, F.lit("roman_has_telugu_chars")))))
    out = out.withColumn("score_reasons", reasons).withColumn("quality_score", F.when(F.col("_zero").isNotNull(), 0.0).otherwise(value)).drop("_zero")
    return out.withColumn("review_status", F.when(F.col("quality_score") < 0.4, "review").otherwise("approved"))


def route(scored: DataFrame) -> Column:
    """rejected for zero scores, else the review status."""
    return F.when(F.col("quality_score") == 0.0, "rejected").otherwise(F.col("review_status"))


def split(df: DataFrame, cuts: SplitCuts = SplitCuts()) -> DataFrame:
    """Approved rows with a split by the hash of their Telugu text."""
    return df.where("review_status = 'approved'").withColumn("split", text.split_of_key(text.split_key(F.col("telugu_text")), cuts))


def leakage(df: DataFrame, split_col: str = "split") -> DataFrame:
    """(a, b, n): keys of the Telugu text that two splits share; only pairs of splits that share any."""
    per_key = df.where(F.col(split_col).isNotNull()).groupBy(text.split_key(F.col("telugu_text")).alias("_k")).agg(F.array_sort(F.collect_set(split_col)).alias("s")).where(F.size("s") > 1)
    pairs = F.flatten(F.transform("s", lambda a, i: F.transform(F.slice("s", i + 2, F.size("s")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return per_key.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n"))


def seen_filter(new: DataFrame, seen: DataFrame, column: str = "roman_text", order: str = "seq") -> DataFrame:
    """New rows whose text hash is not in ``seen`` (column row_hash), the first of each hash."""
    keyed = new.withColumn("row_hash", text.row_hash(F.col(column)))
    first = keyed.groupBy("row_hash").agg(F.min(order).alias(order))
    return keyed.join(first, ["row_hash", order], "left_semi").join(seen.select("row_hash").distinct(), "row_hash", "left_anti")


def drift(new: DataFrame, reference: DataFrame, script_delta: float = 0.05, length_delta: float = 0.20) -> DataFrame:
    """One row: counts, script shares, length statistics of both sides, their differences, alerts and status; inputs have one text column ``text``. Empty sides give 0."""

    def side(df: DataFrame, name: str) -> DataFrame:
        full = F.when(F.col("text") != "", F.col("text"))
        n = F.char_length(full)
        by_len = df.groupBy(n.alias("len")).agg(F.count(F.lit(1)).alias("c"), F.sum(text.script_share(full)).alias("s"))  # exact order statistics over distinct lengths
        cum = F.sum(F.when(F.col("len").isNotNull(), F.col("c"))).over(Window.orderBy(F.asc_nulls_last("len")).rowsBetween(Window.unboundedPreceding, 0))
        ranked = by_len.withColumn("cum", F.coalesce(cum, F.lit(0))).withColumn("n", F.sum(F.when(F.col("len").isNotNull(), F.col("c"))).over(Window.partitionBy(F.lit(1))))
        at = lambda k: F.min(F.when(F.col("len").isNotNull() & (F.col("cum") > k), F.col("len")))
        mid = (at(F.floor((F.col("n") - 1) / 2)) + at(F.floor(F.col("n") / 2))) / 2
        zero = lambda c: F.coalesce(c, F.lit(0.0))
        return ranked.agg(F.coalesce(F.sum("c"), F.lit(0)).alias(f"{name}_count"), zero(F.sum(F.when(F.col("len").isNotNull(), F.col("s"))) / F.max("n")).alias(f"{name}_script"), F.round(zero(F.sum(F.col("len") * F.col("c")) / F.max("n")), 1).alias(f"{name}_mean"), zero(mid).alias(f"{name}_median"), F.coalesce(at(F.floor(F.col("n") * 0.95)), F.lit(0)).cast("bigint").alias(f"{name}_p95")).withColumn("_k", F.lit(1))

    both = side(new, "new").join(side(reference, "ref"), "_k").drop("_k")
    both = both.withColumn("script_share_delta", F.abs(F.col("new_script") - F.col("ref_script"))).withColumn("length_delta", F.abs(F.col("new_mean") - F.col("ref_mean")) / F.greatest("ref_mean", F.lit(1.0)))
    alerts = F.array_compact(F.array(F.when(F.col("script_share_delta") > script_delta, F.lit("script_ratio")), F.when(F.col("length_delta") > length_delta, F.lit("mean_length"))))
    both = both.withColumn("alerts", alerts)
    rounded = {c: F.round(c, 4) for c in ("new_script", "ref_script", "script_share_delta", "length_delta")}
    return both.withColumns(rounded).withColumn("status", F.when(F.size("alerts") > 0, "DRIFT_DETECTED").otherwise("OK"))
