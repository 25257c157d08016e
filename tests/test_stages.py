"""Curation stages on small fixtures."""

import os

import pytest
from pyspark.sql import functions as F

from lekha.config import NearDup
from lekha.functions import translit
from lekha.operators import curate, evaluate
from lekha.operators.skew import heavy_hashes, join_group_values, salted_join, two_level_counts
from lekha.plans import pipeline
from lekha.schemas import MANIFEST, PAIR, RAW
from lekha.sources import files, generated
from lekha.streaming import curation

RAW_COLS = [c.split()[0] for c in RAW.split(", ")]
PAIR_COLS = [c.split()[0] for c in PAIR.split(", ")]


def raw(spark, rows):
    full = {"source_url": "u", "license_tag": "CC-BY-4.0", "pull_timestamp_utc": "2026-04-05T00:00:00Z", "lang_hint": "te", "row_hash": "h"}
    return spark.createDataFrame([tuple((full | {"seq": i} | r).get(c) for c in RAW_COLS) for i, r in enumerate(rows)], RAW)


def pairs(spark, rows):
    full = {"pair_id": "p", "roman_text": "nenu", "telugu_text": "నేను", "source_name": "s", "license_tag": "l", "pair_source": "direct", "quality_score": 0.9, "confidence": 0.85, "review_status": "approved", "created_at": "t"}
    return spark.createDataFrame([tuple((full | r).get(c) for c in PAIR_COLS) + (i,) for i, r in enumerate(rows)], PAIR + ", seq bigint")


def test_normalize_keeps_columns_and_reasons(spark):
    df = raw(spark, [{"text_raw": "  నేను ", "script_hint": "telugu"}, {"text_raw": "  "}, {"text_raw": None}, {"text_raw": "abc", "script_hint": "telugu"}, {"text_raw": "abc"}]).withColumn("extra", F.lit(1))
    out = curate.normalize(df).orderBy("seq").collect()
    assert [r.drop_reason for r in out] == [None, "empty_after_normalize", "empty_after_normalize", "telugu_hint_no_script", None]
    assert out[0].text_normalized == "నేను" and out[0].text_raw == "  నేను " and out[0].extra == 1
    report = curate.stage_report(curate.normalize(df), "normalize", "drop_reason").first()
    assert (report.input_count, report.output_count, report.drop_count, report.drop_reasons) == (5, 2, 3, {"empty_after_normalize": 2, "telugu_hint_no_script": 1})
    assert curate.stage_report(curate.normalize(df.limit(0)), "n", "drop_reason").first().input_count == 0


def test_validate(spark):
    good = {"source_name": "s", "source_doc_id": "d", "text_raw": "x", "script_hint": "roman"}
    out = curate.validate_records(raw(spark, [good, good | {"source_name": None}, good | {"license_tag": "x"}, good | {"text_raw": " "}, good | {"script_hint": "Telugu"}])).orderBy("seq").collect()
    assert [r.passed for r in out] == [True, False, False, False, False]
    assert out[1].reason == "Missing required fields: source_name" and "approved tier" in out[2].reason and "non-empty" in out[3].reason and "must be one of" in out[4].reason
    m = spark.createDataFrame([("r", "s", "t", 1, "f", "MIT", None), ("r", None, "t", 1, "f", "MIT", None), ("r", "s", "t", -1, "f", "MIT", None), ("r", "s", "t", 1, "f", "bad", None)], MANIFEST)
    assert [r.passed for r in curate.validate_manifests(m).collect()] == [True, False, False, False]
    assert not curate.validate_manifests(m.limit(1).withColumn("note", F.lit("x"))).first().passed


def test_lexicon_pairs(spark):
    rows = [{"source_doc_id": "te_lex_1_0", "script_hint": "telugu", "text_raw": "నేను"}, *[{"source_doc_id": f"te_lex_1_{i}", "script_hint": "roman", "text_raw": t} for i, t in enumerate(["nenu", "neenu", "n"], 1)], {"source_doc_id": "te_lex_2_0", "script_hint": "telugu", "text_raw": "మీరు"}, {"source_doc_id": "bad", "script_hint": "roman", "text_raw": "x"}, {"source_doc_id": "te_lex_1_9", "script_hint": "telugu", "text_raw": "రెండు"}]
    out = curate.lexicon_pairs(curate.normalize(raw(spark, rows)))
    assert sorted((r.roman_text, r.telugu_text, r.review_status) for r in out.collect()) == [("n", "నేను", "review"), ("neenu", "నేను", "approved"), ("nenu", "నేను", "approved")]
    assert out.select("pair_id").distinct().count() == 3


def test_crossref_pairs(spark):
    te = {"source_doc_id": "a_te", "script_hint": "telugu", "text_raw": "నేను", "paired_with": "a_ro", "aksharantar_source": "IndicCorp"}
    rows = [te | {"aksharantar_score": -0.05}, te | {"text_raw": "మీరు"}, {"source_doc_id": "a_ro", "script_hint": "roman", "text_raw": "first"}, {"source_doc_id": "a_ro", "script_hint": "roman", "text_raw": "nenu"}, te | {"source_doc_id": "b_te", "paired_with": "none"}, te | {"source_doc_id": "c_te", "paired_with": "a_ro", "aksharantar_score": -0.9}]
    out = curate.crossref_pairs(curate.normalize(raw(spark, rows))).orderBy("confidence").collect()
    assert [(r.roman_text, r.telugu_text, r.confidence, r.review_status) for r in out] == [("nenu", "నేను", 0.1, "review"), ("nenu", "నేను", 0.95, "approved")]


def test_suffix_and_uuid_pairs(spark):
    u = "ea1d165b-0f8c-488c-a3ec-e67a615c51a1"
    rows = [{"source_doc_id": f"syn_food_{u}_ro", "text_raw": "old"}, {"source_doc_id": f"syn_food_{u}_ro", "text_raw": "nenu"}, {"source_doc_id": f"syn_food_{u}_te", "text_raw": "నేను"}, {"source_doc_id": "x_ro", "text_raw": "alone"}, {"source_doc_id": "none", "text_raw": "q"}]
    df = curate.normalize(raw(spark, rows))
    assert [(r.roman_text, r.telugu_text) for r in curate.suffix_pairs(df).collect()] == [("nenu", "నేను")]
    assert [(r.uid, r.roman_text, r.telugu_text, r.source_name) for r in curate.uuid_pairs(df).collect()] == [(u, "nenu", "నేను", "ollama_synthetic")]


def test_fill_and_improve(spark):
    df = pairs(spark, [{"pair_source": "wikipedia_pending", "roman_text": None}, {"pair_source": "wikipedia_pending", "telugu_text": ""}, {}, {"source_name": "wikipedia_te", "telugu_text": "నేను ఇక్కడ ఉన్నాను, మీరు అక్కడ ఉన్నారు కదా; లేదు"}, {"source_name": "wikipedia_te", "telugu_text": "english only text here"}, {"source_name": None}])
    filled = curate.fill_pending(df).orderBy("seq").collect()
    assert [r.seq for r in filled] == [0, 2, 3, 4, 5] and filled[0].roman_text == "nenu" and filled[0].pair_source == "synthetic" and filled[0].quality_score == 0.7
    better = curate.improve_pairs(df).where("seq in (3, 4, 5)").orderBy("seq", "telugu_text").collect()
    assert [(r.seq, r.telugu_text) for r in better] == [(3, "నేను ఇక్కడ ఉన్నాను"), (3, "మీరు అక్కడ ఉన్నారు కదా"), (5, "నేను")]


def test_augment(spark):
    out = curate.augment(pairs(spark, [{"roman_text": "naanu vastanu"}, {"roman_text": None}, {"confidence": 0.5}, {"review_status": "review"}]))
    new = out.where("pair_source = 'augmented'").collect()
    assert 1 <= len(new) <= 5 and {r.augmentation_variant for r in new} == {"naanu vastanu"} and {r.quality_score for r in new} == {0.81}
    assert out.count() == 4 + len(new)


def test_exact_dedup(spark):
    df = pairs(spark, [{}, {"roman_text": " NENU "}, {"roman_text": "nenu1"}, {"roman_text": None}, {"roman_text": ""}])
    assert sorted(r.seq for r in curate.exact_dedup(df).collect()) == [0, 2, 3]
    assert curate.exact_dedup(df.limit(0)).count() == 0


def test_near_dedup_greedy(spark, monkeypatch):
    texts = ["nenu vastunna ela unnav bro", "nenu vastunna ela unnav bro", "completely other words here", "ab", "ab", "nenu vastunna ela unnav broo"]
    df = pairs(spark, [{"roman_text": t} for t in texts])
    kept = sorted(r.seq for r in curate.near_dedup(df, near=NearDup(bands=32)).collect())
    assert kept[:1] == [0] and 1 not in kept and {2, 3, 4} <= set(kept)
    assert curate.near_dedup(df, near=NearDup(max_rows=2)).count() == 6


def test_near_dedup_of_large_input(spark):
    df = spark.range(200_001).select(F.col("id").alias("seq"), F.lit("ab").alias("roman_text"), F.hex("id").alias("telugu_text"))
    df = df.unionByName(spark.createDataFrame([(300_000, "nenu repu vastanu akkadaki", "a"), (300_001, "Nenu repu vastanu akkadaki", "b")], df.schema))
    assert [tuple(r) for r in curate.dedup_report(df).select("input_count", "near_dupes").collect()] == [(200_003, 1)]


@pytest.mark.parametrize("bands", [NearDup().bands, 32])
def test_near_dedup_equals_sequential_rule(spark, bands):
    import random

    from lekha.functions.minhash import band_keys

    r = random.Random(1)
    texts = []
    for _ in range(150):
        t = "".join(r.choice("abcde ") for _ in range(r.randint(3, 30))) if not texts or r.random() < 0.3 else r.choice(texts)
        p = r.randrange(len(t) + 1)
        texts.append((t[:p] + r.choice("abc") + t[p:]).strip().ljust(3, "x"))
    keys = band_keys(texts, 3, 128, bands)
    kept: list[int] = []
    for i in range(len(texts)):
        if not any((keys[i] == keys[k]).any() for k in kept):
            kept.append(i)
    df = pairs(spark, [{"roman_text": t} for t in texts])
    assert sorted(x.seq for x in curate.near_dedup(df, near=NearDup(bands=bands)).collect()) == kept and len(kept) < 150


def test_score_and_route(spark):
    cases = [({}, 0.94, ""), ({"roman_text": ""}, 0.0, "roman_too_short"), ({"roman_text": "hello", "telugu_text": "hello"}, 0.0, "telugu_no_script"), ({"telugu_text": "న", "roman_text": "much too long", "confidence": 0.0}, 0.36, "length_ratio_out_of_range:13.00"), ({"pair_source": "augmented"}, 0.91, ""), ({"confidence": None}, 0.9, ""), ({"roman_text": "neనను"}, 0.76, "roman_has_telugu_chars")]
    out = curate.score(pairs(spark, [c[0] for c in cases])).orderBy("seq").collect()
    assert [(r.quality_score, ",".join(r.score_reasons)) for r in out] == [c[1:] for c in cases]
    assert {r.route: r.n for r in pipeline.route_counts(curate.score(pairs(spark, [c[0] for c in cases]))).collect()} == {"approved": 4, "rejected": 2, "review": 1}


def test_split_and_leakage(spark):
    out = curate.split(pairs(spark, [{}, {"telugu_text": " నేను"}, {"review_status": "review"}]))
    assert out.count() == 2 and out.select("split").distinct().count() == 1
    both = pairs(spark, [{}, {}, {"telugu_text": "మీరు"}, {}]).withColumn("split", F.element_at(F.array(*map(F.lit, ["train", "val", "val", "test"])), F.col("seq").cast("int") + 1))
    assert sorted(tuple(r) for r in curate.leakage(both).collect()) == [("test", "train", 1), ("test", "val", 1), ("train", "val", 1)]


def test_drift(spark):
    a = spark.createDataFrame([("x" * i,) for i in range(1, 21)] + [(None,), ("",)], "text string")
    r = curate.drift(a, a).first()
    assert (r.new_count, r.new_mean, r.new_median, r.new_p95, r.status) == (22, 10.5, 10.5, 20, "OK")
    shifted = curate.drift(a, spark.createDataFrame([("నేను",)], "text string")).first()
    assert shifted.status == "DRIFT_DETECTED" and shifted.alerts == ["script_ratio", "mean_length"]
    assert curate.drift(a.limit(0), a.limit(0)).first().new_count == 0


def test_generated(spark):
    answers = ['```json\n[{"roman_text": "nenu vastanu", "telugu_text": "నేను వస్తాను"}]\n```', 'text [{"roman": "meeru ela", "telugu": "మీరు ఎలా"}, {"roman": "12345", "telugu": "మీరు"}] end', '[{"roman": "ok ra", "telugu": "సరే రా"}, {broken]', "none", None]
    df = spark.createDataFrame(list(enumerate(answers)), "seq bigint, answer string")
    got = generated.parsed_pairs(df).orderBy("seq", "item").collect()
    assert [(r.roman_text, r.refused) for r in got] == [("nenu vastanu", None), ("meeru ela", None), ("12345", "roman has no ASCII letters"), ("ok ra", None)]
    seen = spark.createDataFrame([("nenu vastanu",)], "t string").select(F.sha2("t", 256).alias("row_hash"))
    assert sorted(r.roman_text for r in generated.accepted_pairs(df, seen).collect()) == ["meeru ela", "ok ra"]
    assert {r.seq: (r.parsed, r.accepted, r.notes[0]) for r in generated.trace(df).collect()} == {0: (1, 1, "rejected=0"), 1: (2, 1, "rejected=1"), 2: (1, 1, "rejected=0"), 3: (0, 0, "rejected=0"), 4: (0, 0, "unavailable")}
    asked = []
    assert generated.generate(lambda n: asked.append(n) or "x", lambda a: 10, 25) == 30 and asked == [15, 15, 12]
    assert generated.generate(lambda n: "x", lambda a: 0, 5) == 0 and generated.generate(lambda n: None, lambda a: 1, 5) == 0


def test_review_scores(spark):
    df = pairs(spark, [{}, {"roman_text": "bad"}, {"roman_text": "slow"}])

    def ask(te, ro):
        if ro == "slow":
            raise TimeoutError
        return "no json" if ro == "bad" else 'ok {"confidence_score": 0.7, "reason_code": "fine", "flag_for_review": true}'

    out = generated.review_scores(df, ask).orderBy("seq").collect()
    assert [(r.ollama_score, r.ollama_reason, r.ollama_flag) for r in out] == [(0.7, "fine", True), (None, "empty_response", False), (None, "timeout", False)]
    assert generated.review_scores(df, None, most=2).count() == 2


def test_predictions(spark):
    out = generated.predictions(pairs(spark, [{}, {"roman_text": None}]), lambda ts: [t.upper() for t in ts])
    assert sorted(r.prediction for r in out.collect()) == ["", "NENU"]


def test_clients_that_fail(spark):
    waits, calls = [], []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise ConnectionError
        return "ok"

    assert generated.with_retries(flaky, wait=waits.append)("q") == "ok" and waits == [2.0, 4.0]
    assert generated.with_retries(lambda: (_ for _ in ()).throw(TimeoutError()), wait=waits.append)() is None
    df = pairs(spark, [{"roman_text": "a"}, {"roman_text": "bad"}, {"roman_text": None}])
    chat = lambda t: 1 / 0 if t == "bad" else f"\n  {t}!\nmore"
    assert [r.prediction for r in generated.chat_predictions(df, chat).orderBy("seq").collect()] == ["a!", None, "!"]

    def lost(texts):
        raise ConnectionError

    assert generated.predictions(df, lost).where("prediction is null").count() == 3
    ask = generated.scored_by(lambda prompt: '{"confidence_score": 0.4, "reason_code": "' + prompt + '"}', "T {telugu_text} R {roman_text} {x}")
    assert [r.ollama_reason for r in generated.review_scores(df, ask, most=None).orderBy("seq").collect()] == ["T నేను R a {x}", "T నేను R bad {x}", "T నేను R  {x}"]


def test_generated_records_pair_again(spark):
    made = spark.createDataFrame([("nenu", "నేను", "food"), ("meeru", "మీరు", None)], "roman_text string, telugu_text string, category string")
    rows = generated.generated_records(made, "ts", "m", "v1").withColumn("seq", F.monotonically_increasing_id())
    assert rows.count() == 4 and {r.license_tag for r in rows.collect()} == {"Apache-2.0"}
    assert sorted((r.roman_text, r.telugu_text) for r in curate.uuid_pairs(rows).collect()) == [("meeru", "మీరు"), ("nenu", "నేను")]
    assert curate.validate_records(rows).where("not passed and reason not like 'Missing%'").count() == 0


def test_curated_pairs_keep_the_original(spark, rows):
    """An original stays where its variant is spelt alike, whatever the identifiers and the partitions; snapshots are apart unless asked."""
    lex = lambda n, ro, te: [{"source_name": "dakshina", "source_doc_id": f"te_lex_{n}_0", "text_raw": te, "script_hint": "telugu", "license_tag": "MIT"}, *({"source_name": "dakshina", "source_doc_id": f"te_lex_{n}_{i}", "text_raw": r, "script_hint": "roman", "license_tag": "MIT"} for i, r in enumerate(ro, 1))]
    given = lex(1, ["naanu vastanu", "nanu vastanu"], "నాను వస్తాను") + lex(2, ["vastanu"], "వస్తాను") + [{"source_name": "samanantar", "source_doc_id": "s", "text_raw": "వస్తాను", "script_hint": "telugu", "license_tag": "MIT"}]
    df = raw(spark, given)
    out = []
    for n in ("1", "4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(rows(pipeline.curated_pairs(df.repartition(int(n)), near=None).select("telugu_text", "roman_text", "pair_source", "quality_score", "snapshot", "pair_order")))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1] == out[2]
    by = {(r[0], r[1], r[4]): r[2] for r in out[0]}
    assert by["నాను వస్తాను", "nanu vastanu", "dakshina"] == "augmented"  # the variant of the row before comes first in the file
    assert by["నాను వస్తాను", "naanu vastanu", "dakshina"] == "direct" and by["వస్తాను", "vastanu", "dakshina"] == "direct" and by["వస్తాను", "vastanu", "samanantar"] == "synthetic"
    whole = pipeline.curated_pairs(df, near=None, per_snapshot=False)
    assert whole.where("telugu_text = 'వస్తాను' and roman_text = 'vastanu'").select("snapshot").collect() == [("dakshina",)]
    assert pipeline.curated_pairs(df).count() > 0


def test_near_dedup_within_values(spark):
    df = pairs(spark, [{"roman_text": "nenu vastunna ela unnav bro"}, {"roman_text": "nenu vastunna ela unnav bro"}, {"roman_text": "nenu vastunna ela unnav bro", "source_name": None}, {"roman_text": "nenu vastunna ela unnav bro", "source_name": "other"}])
    assert sorted(r.seq for r in curate.near_dedup(df, by=["source_name"]).collect()) == [0, 2, 3] and sorted(r.seq for r in curate.exact_dedup(df, by=["source_name"]).collect()) == [0, 2, 3]


def _scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan"), plan.count("Exchange ")


def test_plans_read_their_input_once(spark, tmp_path):
    path = str(tmp_path / "t")
    pairs(spark, [{}, {}]).withColumn("filename", F.lit("a_20260101.jsonl")).withColumns({"row_hash": F.lit("h"), "size_bytes": F.lit(1)}).write.parquet(path)
    df = spark.read.parquet(path)
    assert _scans(curate.exact_dedup(df)) == (1, 1)
    assert _scans(files.snapshot_index(df))[0] == 2


@pytest.mark.parametrize("text_, want", [("కై", "kai"), ("కై", "kai"), ("క్ష ఋషి ఞ ౧౨", "ksha rrishi na 12"), ("Abc  Mం", "abc mm"), (None, None), ("", "")])
def test_romanize_letters(spark, text_, want):
    assert spark.createDataFrame([(text_,)], "t string").select(translit.romanize(F.col("t"))).first()[0] == want


@pytest.mark.parametrize("n", [100, 30_000])
def test_skew_helpers(spark, rows, n):
    df = spark.range(n).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    counts = two_level_counts(df, ["k"], "id", n)
    assert "_salt" in counts._jdf.queryExecution().optimizedPlan().toString()
    assert counts.where("k = 0").collect()[0][1:] == (n // 2, 0) and counts.count() == n // 2 + 1
    joined = join_group_values(df, counts, ["k"], "n", n)
    assert joined.count() == n and joined.where("k = 0 and first_id = 0").count() == n // 2
    left = join_group_values(df, counts.where("n > 1"), ["k"], "n", n, how="left")
    assert left.count() == n and left.where("first_id is null").count() == n // 2
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, v string")
    assert salted_join(df, small, ["k"]).groupBy("v").count().collect().__len__() == 2
    assert salted_join(df, small, ["k"]).count() == n // 2 + 1


def test_salted_join_splits_both_sides(spark, rows):
    left = spark.range(300).select(F.when(F.col("id") < 100, 7).when(F.col("id") < 150, 8).otherwise(F.col("id")).alias("k"), F.col("id").alias("a"))
    right = spark.range(300).select(F.when(F.col("id") < 90, 7).when(F.col("id") < 110, 9).otherwise(F.col("id")).alias("k"), F.col("id").alias("b")).withColumn("k", F.when(F.col("b") == 299, None).otherwise(F.col("k")))
    for x, y in ((left, right), (right, left), (left, right.where("k != 7")), (left.where("k > 200"), right.where("k > 200"))):
        assert rows(salted_join(x, y, ["k"], salts=5).select("k", "a", "b")) == rows(x.join(y, "k").select("k", "a", "b"))
    assert salted_join(left.limit(0), right, ["k"]).count() == 0
    hot = heavy_hashes(left.repartition(7), F.col("k"), 10)
    assert 7 in hot and 8 in hot and len(hot) <= 13 and heavy_hashes(left.limit(0), F.col("k")) == []


def test_tables_belong_to_the_application(spark):
    from lekha import session

    one, other = session.materialize(spark.range(3), "mine"), session.materialize(spark.range(4), "kept")
    path = one.inputFiles()[0]
    assert spark.sparkContext.applicationId in path
    session.discard(one, spark.range(2))
    assert not os.path.exists(path.removeprefix("file://")) and other.count() == 4


def test_pipeline_end_to_end(spark):
    rows_ = [{"source_name": "dakshina", "source_doc_id": "te_lex_1_0", "script_hint": "telugu", "text_raw": "నేను"}, {"source_name": "dakshina", "source_doc_id": "te_lex_1_1", "script_hint": "roman", "text_raw": "nenu"}, {"source_name": "wikipedia_te", "source_doc_id": "wiki_1_s0", "script_hint": "telugu", "text_raw": "నేను ఇక్కడ ఉన్నాను, మీరు అక్కడ ఉన్నారు"}, {"source_name": "unknown", "source_doc_id": "q", "script_hint": "telugu", "text_raw": "నేను"}]
    scored = pipeline.curated_pairs(raw(spark, rows_))
    again = pipeline.curated_pairs(raw(spark, rows_))
    key = lambda d: sorted((r.roman_text, r.telugu_text, r.pair_source, r.quality_score) for r in d.collect())
    assert key(scored) == key(again) and ("nenu", "నేను", "direct", 0.96) in key(scored)
    assert pipeline.dataset(scored).where("split is null").count() == 0


def test_assembly(spark):
    a, b = pairs(spark, [{}]), pairs(spark, [{}, {}]).withColumn("score_reasons", F.array())
    assert pipeline.union_sources(a, None, b).count() == 3 and pipeline.scored_else_deduped([], [a]).count() == 1 and pipeline.scored_else_deduped([b], [a]).count() == 2
    many = pairs(spark, [{}] * 20)
    assert pipeline.shuffled(many).collect() == pipeline.shuffled(many).collect() != many.collect()


def test_files(spark, tmp_path):
    import json
    import tarfile
    import zipfile

    lines = [json.dumps({"native word": "నేను", "english word": "nenu", "unique_identifier": "u1", "source": "Dakshina", "score": None}), "", json.dumps({"native word": " ", "english word": "x"})]
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("tel_train.json", "\n".join(lines))
    got = files.zip_pairs(spark, str(tmp_path / "a.zip"), "t").orderBy("source_doc_id").collect()
    assert [(r.source_doc_id, r.text_raw, r.paired_with) for r in got] == [("train_u1_ro", "nenu", "train_u1_te"), ("train_u1_te", "నేను", "train_u1_ro")]

    (tmp_path / "lex.tsv").write_text("# c\nనేను\tnenu\t\tneenu\n \tx\n", encoding="utf-8")
    with tarfile.open(tmp_path / "b.tar", "w") as t:
        t.add(tmp_path / "lex.tsv", "lex.tsv")
    got = files.tar_lexicon(spark, str(tmp_path / "b.tar"), "lex.tsv", "t").orderBy("source_doc_id").collect()
    assert [(r.source_doc_id, r.script_hint) for r in got] == [("te_lex_2_0", "telugu"), ("te_lex_2_1", "roman"), ("te_lex_2_3", "roman")]

    (tmp_path / "t.tsv").write_text("doc_id\troman_text\ttelugu_text\n1\tnenu\tనేను\n2\t\tx\n", encoding="utf-8")
    got = files.table_pairs(spark, str(tmp_path / "t.tsv"), "t", "ilci_corpus", "u", "CC-BY-NC-4.0", "c@d")
    assert got.count() == 2 and got.first().takedown_contact == "c@d"

    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "dak_20260101.jsonl").write_text("".join(json.dumps({"row_hash": f"h{i}", "source_name": "d"}) + "\n" for i in range(7)) + "\nnot json\n")
    (tmp_path / "raw" / "other.jsonl").write_text("{}\n")
    idx = files.snapshot_index(files.snapshot_rows(spark, str(tmp_path / "raw"))).collect()
    assert len(idx) == 1 and idx[0].record_count == 8 and idx[0].row_hashes_sample == [f"h{i}" for i in range(5)] and idx[0].pull_date == "20260101"
    tolerant = files.read_jsonl(spark, str(tmp_path / "raw" / "dak_20260101.jsonl"), "row_hash string, source_name string")
    assert tolerant.count() == 8 and tolerant.where("_corrupt is not null").count() == 1
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "raw" / "dak_20260101.jsonl"), "row_hash string", strict=True).collect()

    df = pairs(spark, [{}, {"roman_text": None}])
    files.write_jsonl(df, str(tmp_path / "out"))
    with pytest.raises(Exception):
        files.write_jsonl(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    files.write_routed(curate.score(df), str(tmp_path / "routed"), "review_status")
    files.write_snapshot(df, str(tmp_path / "snap"))
    files.write_jsonl(df, str(tmp_path / "out"), mode="append")
    assert spark.read.json(str(tmp_path / "out")).count() == 4
    manifest = {"run_id": "r", "source_name": "s", "pull_timestamp_utc": "t", "record_count": 2, "output_file": "f", "license_tag": "MIT", "split_counts": {"train": 2}}
    files.write_manifest(spark, str(tmp_path / "m"), **manifest)
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "m")).select("run_id", "record_count", "split_counts.train").collect()] == [("r", 2, 2)]
    for broken in ({"record_count": -1}, {"license_tag": "none"}, {"source_name": None}):
        with pytest.raises(ValueError):
            files.write_manifest(spark, str(tmp_path / "broken"), **(manifest | broken))


def test_lines_follow_the_sorted_files(spark, tmp_path):
    """Files of very different size and several blocks: numbers follow the names, then the lines."""
    want = []
    for name, n in (("c", 3), ("a", 4000), ("b", 1)):
        (tmp_path / f"{name}.jsonl").write_text("".join(f'{{"x": "{name}{i}"}}\n' + ("\n" if i == 1 else "") for i in range(n)))
    for name, n in (("a", 4000), ("b", 1), ("c", 3)):
        want += [f"{name}{i}" for i in range(n)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = files.read_jsonl(spark, str(tmp_path), "x string", order=True).orderBy("seq").collect()
        assert [r.x for r in got] == want and [r.seq for r in got][:3] == [0, 1, 3]
        assert files.numbered(spark.range(0), "id").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_configuration(spark):
    config = {"slices": [{"name": "mix", "source_names": ["a"], "filter": "roman_has_actual_english", "english_words": ["bus"]}, {"name": "long", "min_roman_length": 3, "pair_sources": ["direct"]}, {"name": "share", "filter": "roman_has_english_words", "min_english_word_ratio": 0.5}], "acceptance_targets": {"cer_mix_max": 0.2, "note": "x"}}
    slices, targets = files.eval_config(config)
    assert targets == (("mix", 0.2),) and [s.name for s in slices] == ["mix", "long", "share"] and files.eval_config({}) == ((), ())
    df = pairs(spark, [{"source_name": "a", "roman_text": "nenu Bus, lo"}, {"source_name": "a", "roman_text": "నేను"}, {"source_name": None, "roman_text": None}]).withColumn("prediction", F.col("telugu_text"))
    got = {r.slice: r["count"] for r in evaluate.by_slice(df, slices).collect()}
    assert got == {"overall": 3, "mix": 1, "long": 2, "share": 1}
    assert evaluate.acceptance(evaluate.by_slice(df, slices), targets).first().met


def test_article_and_parallel(spark):
    t = "నేను ఇక్కడ ఉన్నాను మరియు మీరు అక్కడ।short\nenglish sentence that is long enough to count"
    got = files.article_sentences(spark.createDataFrame([(7, t, "T", "U"), (8, None, None, None)], "id bigint, text string, title string, url string"), "ts").collect()
    assert [(r.source_doc_id, r.source_url, r.article_title) for r in got] == [("wiki_7_s0", "U", "T")]
    df = spark.createDataFrame([(1, "చిన్న"), (2, "నేను ఇక్కడ ఉన్నాను"), (3, None), (4, "మీరు అక్కడ ఉన్నారు కదా")], "seq bigint, tgt string")
    assert [r.source_doc_id for r in files.parallel_rows(df, "t").orderBy("source_doc_id").collect()] == ["sam_te_0", "sam_te_1"]


def test_stream_equals_batch(spark, tmp_path, rows):
    df = raw(spark, [{"source_name": "s", "text_raw": "  నేను ", "script_hint": "telugu"}, {"source_name": "s", "text_raw": "a"}, {"source_name": "s", "text_raw": "hello there"}])
    files.write_jsonl(df, str(tmp_path / "in"))
    stream = curation.clean_stream(curation.raw_stream(spark, str(tmp_path / "in"), RAW))
    curation.write_clean(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    want = df.transform(curate.normalized_rows).transform(curate.clean_rows)
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("seq", "text_normalized")) == rows(want.select("seq", "text_normalized"))


def test_encoded(spark):
    from lekha.functions import tokens

    out = tokens.encoded(pairs(spark, [{"roman_text": "ab", "telugu_text": "న"}, {"roman_text": None, "telugu_text": "abcdefgh"}]), input_length=4, target_length=5).orderBy("seq").collect()
    assert [(r.input_ids, r.attention_mask, r.labels, r.cut) for r in out] == [([100, 101, 1, 0], [1, 1, 1, 0], [227, 179, 171, 1, -100], False), ([1, 0, 0, 0], [1, 0, 0, 0], [100, 101, 102, 103, 1], True)]
