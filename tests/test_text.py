"""Scalar functions against literals and plain Python."""

import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lekha.functions import rules, text, translit
from lekha.functions.canonical import telugu_first, words_of


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize(("raw", "want"), [("  నేను  ", "నేను"), ("hello\x00world\x1ftest", "helloworldtest"), ("line1\n\nline2", "line1 line2"), ("a\u00a0 b\u3000c", "a b c"), ("a\x0bb", "ab"), ("cafe\u0301", "café"), ("", "")])
def test_normalized(spark, raw, want):
    assert one(spark, raw, text.normalized) == want


@pytest.mark.parametrize(("t", "want"), [("nenu", None), ("a", "too_short"), ("1", "too_short"), ("https://x.com", "url_only"), ("😂😂😂", "emoji_only"), ("1234567890", "high_digit_ratio"), ("aaaaaaaaaa", "high_repeat"), ("a" * 513, "too_long"), ("check https://example.com for more", None), ("", "too_short"), (None, "too_short"), ("aaab", "high_repeat"), ("²²²²1", "high_digit_ratio")])
def test_junk_reason(spark, t, want):
    assert one(spark, t, text.junk_reason) == want


def test_script(spark):
    assert one(spark, "నేను", text.detect_script) == "telugu"
    assert one(spark, "nenu 12", text.detect_script) == "roman"
    assert one(spark, "123 456", text.detect_script) == "mixed"
    assert one(spark, "", text.script_share) == 0.0


def test_split_boundaries(spark):
    keys = {58981: "train", 58982: "val", 62258: "val", 62259: "test", 0: "train", 65535: "test"}
    assert {k: one(spark, f"{k:04x}" + "0" * 28, text.split_of_key) for k in keys} == keys


def test_source_confidence(spark):
    cases = [("Dakshina", None, 0.90), ("IndicCorp", -0.05, 0.95), ("IndicCorp", -0.9, 0.1), ("Samanantar", None, 0.85), ("IndicCorp", None, 0.75), ("IndicCorp", -3.0, 0.0), ("IndicCorp", float("nan"), 0.75)]
    df = spark.createDataFrame(cases, "s string, c double, want double")
    assert all(r.got == r.want for r in df.select("want", text.source_confidence(F.col("s"), F.col("c")).alias("got")).collect())


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_errors(spark):
    cases = [("abc", "abd"), ("", ""), ("x", ""), ("", "abc"), ("నేను", "నేను"), ("నెను వస్తా", "నేను వస్తాను"), ("a b c d", "a x c"), ("a  a\u00a0b", "b a")]
    df = text.with_word_edits(spark.createDataFrame(cases, "p string, r string"), F.col("p"), F.col("r")).withColumn("cer", text.cer(F.col("p"), F.col("r")))
    for x in df.collect():
        want = (0.0 if not x.p else 1.0) if not x.r else lev(x.p, x.r) / len(x.r)
        assert x.cer == want and x.word_edits == lev(x.p.split(), x.r.split()) and x.ref_words == len(x.r.split()), x


def test_substitutions(spark):
    df = spark.createDataFrame([("abc", "axcd"), ("", "a")], "p string, r string")
    got = [[tuple(y) for y in x[0]] for x in df.select(text.substitutions(F.col("p"), F.col("r"))).collect()]
    assert got == [[("x", "b")], []]


def test_romanize_goldens(spark):
    for te, ro in {"నేను": "nenu", "మీరు": "miru", "తెలుగు": "telugu", "కేంద్రంలో ఇద్దరు": "kemdramlo iddaru", "క్షమ": "kshama", "": ""}.items():
        assert one(spark, te, translit.romanize) == ro


def test_to_telugu(spark):
    df = translit.with_telugu(spark.createDataFrame([("nenu",), ("123",), (None,), ("ikkaDa",), ("kSha",)], "x string"), "x", "y")
    assert [r.y for r in df.select("y").collect()] == ["నేను", "౧౨౩", "", "ఇక్కడ", "క్ష"]


def test_small_functions(spark):
    assert one(spark, "anthey ey they", text.shorten_ey) == "anthe ey the"
    assert one(spark, "నాఆకు", text.fix_doubled_signs) == "నాకు"
    assert one(spark, 'x {"a": {"b": 1}} y', text.json_object) == '{"a": {"b": 1}}'
    assert one(spark, "none", text.json_object) is None
    assert one(spark, "please call me now", lambda c: text.has_listed_words(c, ["call"])) is True
    assert one(spark, "ok a నేను", text.has_english_words) is True
    assert one(spark, "", text.has_english_words) is False
    assert one(spark, "nenu vastunnanu", text.is_clean_prompt) is True
    assert one(spark, "nenu [vastunnanu]", text.is_clean_prompt) is False
    assert one(spark, "x" * 10, text.length_bucket) == "medium (10-30)"


def py_variants(roman, most=5):
    """Plain model of the variant rules."""
    seen = []

    def add(cands):
        seen.extend(v for v in dict.fromkeys(cands) if v != roman and v not in seen)

    def tier(tier_rules, room):
        found = []
        for pattern, reps in tier_rules:
            hit = re.search(pattern, roman)
            for rep in reps[: rules.TRIED] if hit else ():
                v = roman[: hit.start()] + hit.expand(rep) + roman[hit.end() :]
                if v != roman and v.strip():
                    found.append(v.strip())
            if len(found) >= room:
                return found
        return found

    def words():
        w = roman.split()
        return [" ".join([*w[:i], s, *w[i + 1 :]]) for i, x in enumerate(w) for s in rules.WORD_SUBS.get(x.lower(), ())[: rules.TRIED]]

    add(tier(rules.TIER1, most))
    for step in (lambda: tier(rules.TIER2, most - len(seen)), words, lambda: tier(rules.TIER3, most - len(seen))):
        if len(seen) < most:
            add(step())
    return seen[:most]


def test_variants_match_model(spark):
    words = ["naanu vastanu", "vastanu", "wastanu", "ikkaDa ledu", "khaalii ghanta bhai", "thoda thanks ok", "pakka zaroor", "anthey antey", "x", "ekdum mast", "Tappu Dabbu", "lo la ra", "nuvvu nenu", "lakshmi", "a", "veltunnaanu to", "aamba kampa", ""]
    words += [r.strip() for pats in (rules.TIER1, rules.TIER2, rules.TIER3) for r in (re.sub(r"\\b|\(\?[^)]*\)|[()\\^]|\[[^\]]*\]", "a", p) for p, _ in pats)]
    df = spark.createDataFrame([(w,) for w in words], "x string").select("x", rules.variants(F.col("x")).alias("v"))
    assert {r.x: list(r.v) for r in df.collect()} == {w: py_variants(w) for w in words}
    assert "nanu vastanu" in py_variants("naanu vastanu")


@pytest.mark.parametrize(("text_", "want"), [
    ("avunu ikkada", ["avunu ikada", "avun ikkada", "avuni ikkada", "avunaa ikkada", "avuna ikkada"]), ("vastanu", ["wastanu", "vastan", "vastani"]),
    ("bhai thanks", ["bai thanks", "bhay thanks", "bhaay thanks", "bhai thanx", "bhai thnx"]), ("okay", ["ok", "okey", "okayu", "okk"]),
    ("nenu ledu", ["nen ledu", "neni ledu", "nenu le", "nenu ledhu", "neenu ledu"]), ("sh ch Ta ksh", ["s ch Ta ksh", "sh c Ta ksh", "sh ch ta ksh", "sh ch Ta x", "sh ch Ta ks"]), ("", []), (None, []),
])
def test_variants_literally(text_, want):
    """Pins rules and word substitutes, apart from their tables."""
    assert rules.variant_batch([text_], 5) == [want]


@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=20), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_words_of_is_rowwise(texts):
    """A batch gives what each text alone gives."""
    assert words_of(texts) == [words_of([t])[0] for t in texts]


def test_words_of():
    assert words_of(["Nenu, ఆ\u200cమె 12.5!", None, "", "CAFÉ cafe\u0301", "కై క\u0c46\u0c56"]) == [unicodedata.normalize("NFD", "nenu ఆమె 12 5"), "", "", unicodedata.normalize("NFD", "café café"), unicodedata.normalize("NFD", "కై కై")]
    assert telugu_first(["నేను", "nenu", None], ["nenu", "నేను", "x"]) == (["నేను", "నేను", "x"], ["nenu", "nenu", None])
