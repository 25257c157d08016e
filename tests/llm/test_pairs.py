"""Operators over TranslitPair rows against brute force on small fixtures."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lekha.functions.canonical import telugu_first, words_of
from lekha.llm import canonical_dedup, cutoff, mixing, overlap, related_splits

SCHEMA = "seq bigint, roman_text string, telugu_text string, source_name string, split string, doc_key string, pair_source string, quality_score double"
WORDS = "నేను మీరు ఆమె ఇక్కడ అక్కడ ఇల్లు పని రేపు నిన్న చాలా ఒక రెండు లేదు ఉంది మంచి కొత్త పాత ఊరు నీళ్ళు పుస్తకం".split()


def frame(spark, rows):
    base = {"roman_text": "r", "telugu_text": "నేను", "source_name": "s", "split": "train", "doc_key": None, "pair_source": "direct", "quality_score": 0.5}
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple((base | {"seq": i} | r)[c] for c in names) for i, r in enumerate(rows)], SCHEMA)


def sides(rows):
    te, ro = telugu_first([r.get("roman_text", "r") for r in rows], [r.get("telugu_text", "నేను") for r in rows])
    return words_of(te), words_of(ro)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def corpus(seed, n=260, few_words=False):
    r = random.Random(seed)
    words = WORDS[:6] if few_words else WORDS + [f"{a}{b}" for a in WORDS[:9] for b in WORDS[9:]]
    rows = []
    for i in range(n):
        t = [r.choice(words) for _ in range(r.choice([1, 3, 5, 6, 7, 8, 9, 10, 12, 15, 21, 30]))]
        if rows and r.random() < 0.6:
            t = r.choice(rows)["telugu_text"].replace("!", "").split() or t
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 6])):
                k, p = r.random(), r.randrange(len(t) + 1)
                t = t[:p] + [r.choice(words)] + t[p + (k < 0.5) :] if k < 0.8 else t[:p] + t[p + 1 :]
        rows.append({"telugu_text": " ".join(t) + r.choice(["", "!"]), "split": r.choice(["train", "train", "val", "test", None]), "source_name": r.choice(["a", " A", "b", None]), "doc_key": r.choice([None, *map(str, range(40))])})
    return rows


def near_same(rows):
    """All pairs that p1_found defines, by brute force."""
    te, _ = sides(rows)
    words = [t.split() for t in te]
    held = [j for j, y in enumerate(rows) if y["split"] in ("val", "test")]
    want = set()
    for i, x in enumerate(rows):
        for j in held if x["split"] == "train" else []:
            p, q = words[i], words[j]
            if te[i].replace(" ", "") == te[j].replace(" ", "") or (min(len(p), len(q)) >= 6 and abs(len(p) - len(q)) <= max(len(p), len(q)) // 5 and edits(p, q) <= max(len(p), len(q)) // 5):
                want.add((min(i, j), max(i, j)))
    return want


@pytest.mark.parametrize(("seed", "few", "limits"), [(1, False, {}), (2, True, {}), (7, True, {"bucket_pairs": 2, "hot_parts": 3})])
def test_overlap_equals_brute_force(spark, seed, few, limits):
    rows = corpus(seed, few_words=few)
    want = near_same(rows)
    got = [tuple(r) for r in overlap.found(frame(spark, rows), **limits).collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.99 * len(want) and len(want) > 20
    report = overlap.report(frame(spark, rows), **limits).collect()
    assert sum(r.same_pairs + r.near_pairs for r in report) == len(got)
    held = {(a if rows[a]["split"] != "train" else b) for a, b in got}
    assert sum(r.held_rows for r in report) == len(held)


@pytest.mark.parametrize("limits", [{}, {"bucket_pairs": 50, "hot_parts": 20}])
def test_overlap_with_a_phrase_in_half_of_all_texts(spark, limits):
    r = random.Random(11)
    words = [f"{a}{b}" for a in WORDS for b in WORDS]
    rows = []
    for i in range(400):
        t = [r.choice(words) for _ in range(r.randint(6, 12))]
        if i % 2:
            t[2:2] = WORDS[:8]
        rows.append({"telugu_text": " ".join(t), "split": r.choice(["train", "train", "val"])})
        if i % 10 == 0:
            t[r.randrange(len(t))] = "కొత్తది"
            rows.append({"telugu_text": " ".join(t), "split": r.choice(["train", "test"])})
    want = near_same(rows)
    got = [tuple(x) for x in overlap.found(frame(spark, rows), **limits).collect()]
    assert len(want) > 10 and set(got) <= want and len(got) >= 0.99 * len(want)


def test_overlap_edges(spark):
    rows = [{"telugu_text": None}, {"telugu_text": "", "split": "val"}, {"split": None}, {"telugu_text": "నేను", "roman_text": "x"}, {"telugu_text": "x", "roman_text": "నే ను!", "split": "test"}]
    assert {tuple(r) for r in overlap.found(frame(spark, rows)).collect()} == {(0, 1), (3, 4)}
    assert overlap.found(frame(spark, rows).limit(0)).count() == 0
    long = " ".join(random.Random(0).choices(WORDS, k=3000))
    assert overlap.found(frame(spark, [{"telugu_text": long}, {"telugu_text": long + " కొత్త", "split": "val"}]).withColumn("words", F.lit("x")).withColumn("te1", F.lit(1))).count() == 1


def test_signatures_share_a_band():
    """Two texts within the edits share a band but for a chance of 0.35 %, whatever their length and words; bands per text are constant."""
    r = random.Random(3)
    met = tried = 0
    for _ in range(1500):
        a = [r.choice("abcd") + r.choice("efgh") for _ in range(r.choice([6, 7, 10, 15, 40]))]
        b = a[:]
        for i in r.sample(range(len(a)), len(a) // 5):
            b[i] = r.choice("xyz")
        keys = overlap.signature([" ".join(a), " ".join(b)])
        assert keys.shape == (2, overlap.BANDS) and (overlap.signature([" ".join(a)]) == keys[:1]).all()
        tried += 1
        met += bool((keys[0] == keys[1]).any())
    assert met >= 0.99 * tried
    assert (overlap.signature(["a a b"]) != overlap.signature(["a b"])).any() and (overlap.signature(["a b a"]) == overlap.signature(["b a a"])).all()


def test_word_edits():
    r = random.Random(4)
    for _ in range(500):
        a, b = ([r.choice("abc") for _ in range(r.randint(0, 9))] for _ in range(2))
        for most in (0, 1, 3, 9):
            assert overlap.word_edits(a, b, most) == min(edits(a, b), most + 1)


def test_canonical_records(spark):
    rows = corpus(5) + [{"roman_text": "నే ను", "telugu_text": "R"}, {"roman_text": "r", "telugu_text": "నేను!"}, {"roman_text": None, "telugu_text": "నేను"}, {"roman_text": "", "telugu_text": "నే‌ను"}]
    te, ro = sides(rows)
    groups = defaultdict(list)
    for i, k in enumerate(zip((t.replace(" ", "") for t in te), (x.replace(" ", "") for x in ro))):
        groups[k].append(i)
    df = frame(spark, rows)
    assert {tuple(r) for r in canonical_dedup.copies(df).collect()} == {(g[0], x) for g in groups.values() for x in g[1:]}
    assert sorted(tuple(r) for r in canonical_dedup.records(df).collect()) == sorted((g[0], len(g)) for g in groups.values())
    assert canonical_dedup.copies(df.limit(0)).count() == 0


def test_cutoffs(spark):
    r = random.Random(6)
    rows = [{"quality_score": r.choice([None, float("nan"), 0.5, 0.5, round(r.random(), 2)]), "source_name": r.choice(["a", " A ", "B", None, "c", " "])} for _ in range(3000)]
    targets = spark.createDataFrame([("a", 70), ("b", 1), ("c", 100), ("none", 50), (None, 10), ("A", 60)], "source_name string, keep_pct bigint")
    want, kept = {}, set()
    for name, pct in (("a", 70), ("b", 1), ("c", 100)):
        mine = [(x["quality_score"], i) for i, x in enumerate(rows) if x["source_name"] and x["source_name"].strip().lower() == name and x["quality_score"] is not None and x["quality_score"] == x["quality_score"]]
        cut = max(c for c, _ in mine if sum(s >= c for s, _ in mine) * 100 >= pct * len(mine))
        want[name] = (cut, len(mine), sum(s >= cut for s, _ in mine))
        kept |= {i for s, i in mine if s >= cut}
    df = frame(spark, rows)
    got = {r.source_name: (r.cutoff, r.rows_scored, r.rows_kept) for r in cutoff.cutoffs(df, targets).collect()}
    assert got == want | {"none": (None, 0, 0)}
    assert {r.seq for r in cutoff.kept(df, targets).collect()} == kept
    assert {r.seq for r in cutoff.kept(df, targets, accuracy=3).collect()} == kept  # a sketch too coarse for its bracket
    assert cutoff.kept(df.limit(0), targets).count() == 0


def test_mixture(spark):
    rows = [{"source_name": "a", "quality_score": 0.9}] * 600 + [{"source_name": " A", "quality_score": None}] * 200 + [{"source_name": "b", "quality_score": float("nan")}] * 50 + [{"source_name": "c"}] * 100 + [{"source_name": None}] * 50
    targets = spark.createDataFrame([("a", "direct", 0.5, 1), ("b", "direct", 0.4, 3), ("c", "direct", 0.1, 4), ("d", "direct", 0.2, 9)], "source_name string, pair_source string, target_share double, max_repeats bigint")
    df = frame(spark, rows)
    got = mixing.mixture(df, targets).collect()
    uses = Counter()
    for r in got:
        uses[r.source_name] += r.uses
    assert len({r.seq for r in got}) == len(got) and max(r.uses for r in got if r.source_name == "a") == 1 and {r.uses for r in got if r.source_name == "b"} == {3}
    assert sum(uses.values()) == 1000 and uses["b"] == 150 and abs(uses["a"] / uses["c"] - 5) < 0.2 and max(r.uses for r in got) <= 4
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mixture(df, targets).collect()))
    report = {r.source_name: r for r in mixing.shares(df, targets).collect()}
    assert report["d"].uses == 0 and report["b"].share == 0.15 and abs(sum(r.share for r in report.values()) - 1) < 1e-9
    weighted = frame(spark, [{"quality_score": 0.9}] * 2000 + [{"quality_score": 0.1}] * 2000)
    one = spark.createDataFrame([("s", "direct", 1.0, 1)], targets.schema)
    high = sum(r.seq < 2000 for r in mixing.mixture(weighted, one, budget=1000).collect())
    assert high > 800  # weights decide who is drawn
    sized = mixing.mixture(df.withColumn("size", F.lit(7)), targets, size="size")
    assert 6900 <= sized.agg(F.sum("uses")).first()[0] * 7 <= 7000
    assert mixing.mixture(df.limit(0), targets).count() == 0 and mixing.mixture(df, targets.limit(0)).count() == 0


def test_groups_and_splits(spark):
    rows = corpus(7, 300)
    te, _ = sides(rows)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, x in enumerate(rows):
        for key in [("t", te[i].replace(" ", ""))] + ([("d", x["source_name"].strip().lower(), x["doc_key"])] if x["source_name"] and x["doc_key"] else []):
            a, b = find(i), find(key)
            parent[a] = b
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    df = frame(spark, rows)
    assert {tuple(r) for r in related_splits.found(df).collect()} == {(g[0], x) for g in members.values() for x in g[1:]}
    shares = spark.createDataFrame([("train", 0.8), ("val", 0.1), ("test", 0.1), (None, 5.0), ("zero", 0.0)], "split_name string, share double")
    out = related_splits.splits(df, shares).collect()
    assert len(out) == len(rows) and all(len({r.split for r in out if r.first_seq == g}) == 1 for g in {r.first_seq for r in out})
    many = frame(spark, [{"telugu_text": f"నేను {i // 2}"} for i in range(6000)])
    reached = Counter(r.split for r in related_splits.splits(many, shares).collect())
    assert abs(reached["train"] / 6000 - 0.8) < 0.03 and abs(reached["val"] / 6000 - 0.1) < 0.02
    giant = frame(spark, [{"telugu_text": "నేను" if i < 2000 else f"మీరు {i}"} for i in range(6000)])
    assert abs(Counter(r.split for r in related_splits.splits(giant, shares, balance=True).collect())["train"] / 6000 - 0.8) < 0.03
    # rendezvous alone: a group's split does not depend on other groups, however large
    alone = {r.first_seq: r.split for r in related_splits.splits(giant.where("seq >= 2000"), shares).collect()}
    assert all(r.split == alone[r.first_seq] for r in related_splits.splits(giant, shares).collect() if r.first_seq >= 2000)
    assert related_splits.splits(df.limit(0), shares).count() == 0 and related_splits.split_report(related_splits.splits(df, shares), shares).count() == 5


def test_hash_to_min_chain(spark):
    n = 200
    chain = spark.createDataFrame([(i, i + 1) for i in random.Random(1).sample(range(n), n)], "a bigint, b bigint")
    got = related_splits.hash_to_min(chain).collect()
    assert len(got) == n + 1 and {r.label for r in got} == {0}
    assert related_splits.hash_to_min(chain.limit(0)).count() == 0


def test_edge_of_the_mixture_is_small(spark, monkeypatch):
    """The rows that are sorted are a sliver of each part at any weights, also where the budget ends among rows of the least weight."""
    df = frame(spark, [{"source_name": f"s{i % 3}", "quality_score": [0.0, 0.01, 1.0][i % 3]} for i in range(30_000)])
    targets = spark.createDataFrame([(f"s{i}", "direct", 1.0, 1) for i in range(3)], "source_name string, pair_source string, target_share double, max_repeats bigint")
    seen = {}
    real = mixing.materialize
    monkeypatch.setattr(mixing, "materialize", lambda d, label: seen.update({label: real(d, label)}) or seen[label])
    out = mixing.mixture(df, targets, budget=15_000.0)
    assert {r.source_name: r.n for r in out.groupBy("source_name").agg(F.sum("uses").alias("n")).collect()} == {f"s{i}": 5000 for i in range(3)}
    assert seen["p3edge"].groupBy("part").count().agg(F.max("count")).first()[0] < 1000
    assert seen["p3edge"].groupBy("part", "fine").count().agg(F.max("count")).first()[0] <= 10
    weights = spark.createDataFrame([("s", "direct", 1.0, 1)], targets.schema)
    heavy = frame(spark, [{"quality_score": 0.9 if i % 2 else 0.1} for i in range(4000)])
    got = {r.seq for r in mixing.mixture(heavy, weights, budget=1000.0).collect()}
    assert len(got) == 1000 and 0.8 < sum(i % 2 for i in got) / 1000 < 0.97


def test_cutoffs_of_many_shares(spark):
    r = random.Random(9)
    rows = [{"source_name": f"s{i % 40}", "quality_score": r.choice([None, round(r.random(), 2), r.random()])} for i in range(4000)]
    targets = spark.createDataFrame([(f"s{i}", i * 2.6) for i in range(41)], "source_name string, keep_pct double")
    got = {x.source_name: x for x in cutoff.cutoffs(frame(spark, rows), targets).collect()}
    for i in range(41):
        scores = sorted((x["quality_score"] for x in rows if x["source_name"] == f"s{i}" and x["quality_score"] is not None), reverse=True)
        fit = [c for c in set(scores) if sum(x >= c for x in scores) * 100 >= i * 2.6 * len(scores) - 1e-9] if i and scores else []
        want = max(fit, default=None) if i * 2.6 <= 100 else min(scores, default=None)
        assert got[f"s{i}"].cutoff == want and got[f"s{i}"].rows_kept == (sum(x >= want for x in scores) if want is not None else 0)
