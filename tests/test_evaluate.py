"""Evaluation analytics on small fixtures."""

import pytest

from lekha.config import EvalSlice
from lekha.operators import evaluate

ROWS = [
    (0, "nenu", "నేను", "dakshina", "direct", "నేను"),
    (1, "meeru", "మీరు", "dakshina", "direct", "మెరు"),
    (2, "ela unnavu", "ఎలా ఉన్నావు", "aksharantar", "augmented", "ఎలా ఉన్నారు"),
    (3, "x", "", "aksharantar", "direct", "x"),
    (4, None, "సరే", None, None, None),
]
SCHEMA = "seq bigint, roman_text string, telugu_text string, source_name string, pair_source string, prediction string"


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_overall_and_micro(df):
    r = evaluate.overall(df).first()
    cers = [0, 1 / 4, 1 / 11, 1, 1]
    assert (r["count"], r.cer, r.exact_match) == (5, round(sum(cers) / 5, 4), 0.2)
    assert r.wer == round((0 + 1 + 1 + 1 + 1) / (1 + 1 + 2 + 0 + 1), 4)
    assert evaluate.micro_cer(df).first().cer == pytest.approx((0 + 1 + 1) / (4 + 4 + 11))
    empty = evaluate.overall(df.limit(0)).first()
    assert empty["count"] == 0 and empty.cer is None


def test_slices(df):
    got = {r.slice: r for r in evaluate.by_slice(df, (EvalSlice("formal", ("dakshina",), ("direct",)), EvalSlice("none", ("zzz",)), EvalSlice("english", english_words=("ela",)))).collect()}
    assert got["overall"]["count"] == 5 and got["formal"]["count"] == 2 and got["none"]["count"] == 0 and got["none"].cer is None and got["english"]["count"] == 1
    assert evaluate.by_slice(df.limit(0)).count() == 4
    card = {r.slice: r for r in evaluate.card_metrics(evaluate.by_slice(df)).collect()}
    assert card["long_sentence"].cer_text == "—" and card["formal"].cer_text == "12.50%"
    met = {r.slice: r.met for r in evaluate.acceptance(evaluate.by_slice(df)).collect()}
    assert met == {"colloquial": True, "formal": False}


def test_compare(spark):
    a = spark.createDataFrame([("x", 0.1), ("y", 0.1), ("z", 0.0), ("only", 0.1), ("n", None)], "slice string, cer double")
    b = spark.createDataFrame([("x", 0.05), ("y", 0.101), ("z", 0.5), ("n", 0.1)], "slice string, cer double")
    got = {r.slice: (r.status, r.pct) for r in evaluate.compare(a, b).collect()}
    assert got["x"][0] == "BETTER" and got["y"][0] == "same" and got["z"] == ("WORSE", 0.0) and got["only"][0] is None and got["n"][0] is None


def test_confusion(df):
    s = evaluate.confusion_summary(df).first()
    assert (s.sample_size, s.failing_count, s.failing_rate) == (5, 3, 0.6)
    groups = {(r.section, r.key): r["count"] for r in evaluate.confusion_groups(df).collect()}
    assert groups["by_source", "dakshina"] == 1 and groups["by_source", ""] == 1 and groups["by_length", "short (<10)"] == 3
    assert [r.seq for r in evaluate.worst(df).collect()] == [3, 4, 1]
    assert [tuple(r) for r in evaluate.top_char_errors(df).collect()] == [("ీ→ె", 1)]


def test_divergent_and_sample(spark, df):
    two = df.selectExpr("*", "case when seq < 3 then telugu_text end as other")
    assert [r.seq for r in evaluate.divergent(two, "prediction", "other").collect()] == [1, 2, 0]
    assert evaluate.sample(df, 3).collect() == evaluate.sample(df, 3).collect() and evaluate.sample(df, 9).count() == 5
