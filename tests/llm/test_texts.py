"""Operators over texts against brute force, literals and round trips."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lekha.functions.canonical import words_of
from lekha.llm import leakage, packing, pair_defects, sentences


@pytest.mark.parametrize(("prompt", "response", "want"), [
    ("nenu vastanu repu", "నేను వస్తాను రేపు", None),
    ("nenu office lo unnanu", "నేను office లో ఉన్నాను!", None),
    ("nenu vastanu repu", None, "empty"), ("nenu", " ​ ", "empty"), ("nenu", "N/A", "empty"), ("nenu", "[]", "empty"), ("nenu vastanu", "...", "empty"),
    ("nenu vastanu", "I'm sorry, but I can't help with this text.", "refusal"), ("nenu", "క్షమించండి, ఈ వాక్యాన్ని నేను మార్చలేను.", "refusal"), ("nenu vastanu", "Mannimchandi, idi cheyadam kudaradu", "refusal"),
    ("sorry nenu raayalenu ippudu", "sorry నేను రాయలేను ఇప్పుడు", None),
    ("nenu vastanu repu", "NENU  vastanu, repu", "copied"), ("nenu vastanu repu akkadaki", "Telugu: nenu vastanu repu akkadaki!", "copied"), ("nenu vastanu repu", "తెలుగు: nenu vastanu repu", "copied"),
    ("nenu vastanu repu", "तुम कल आओगे क्या", "other_language"), ("nenu vastanu repu", "నేను bright window paper stone", "other_language"), ("nenu bus lo unnanu", "ನೇನು bus ಲೋ ಉನ್ನಾನು", "other_language"),
    ("nenu vastanu repu akkadaki mari neevu", "నేను వస్తాను…", "truncated"), ("train nenu vastanu repu", "train", "truncated"),
    ("nenu vastanu repu", "నేనువస్తాను రేపు", None), (None, "నేను", None), ("", "", "empty"),
])
def test_defect(prompt, response, want):
    assert pair_defects.defect(words_of([prompt])[0], words_of([response])[0]) == want


@pytest.mark.parametrize(("response", "want"), [
    ("తెలుగు లిపిలో: nenu vastanu repu", "copied"), ("లిప్యంతరీకరణ: nenu vastanu repu", "copied"), ("ఇక్కడ తెలుగు లిపిలో మీ వాక్యం ఉంది\nNenu vastanu, repu!", "copied"),
    ("Here is the text that you asked me to write in Telugu script: nenu vastanu repu", "copied"), ("నేను: వస్తాను రేపు", None),
])
def test_copy_behind_long_label(response, want):
    assert pair_defects.defect("nenu vastanu repu", words_of([response])[0]) == want


def test_defect_frame(spark):
    df = spark.createDataFrame([(1, "nenu", None, "x"), (2, "nenu", "నేను", None), (2, "nenu", "నేను", None), (3, "repu " * 5000, "రేపు " * 5000, "x")], "seq bigint, roman_text string, telugu_text string, category string").withColumn("defect", F.lit("clash"))
    assert sorted((r.seq, r.defect) for r in pair_defects.labelled(df).collect()) == [(1, "empty"), (2, None), (2, None), (3, None)]
    assert [tuple(r) for r in pair_defects.found(df).collect()] == [(1, "empty")] and pair_defects.found(df.limit(0)).count() == 0
    assert sum(r.rows for r in pair_defects.counts(df.where("seq != 2")).collect()) == 2


@pytest.mark.parametrize(("prompt", "response", "share"), [
    ("nenu", "nenu", 0.1), ("pokhugoro", "తెలుగు pokhugoro", 0.45), ("nenu vastanu repu akkadaki mari neevu ekkada unnavu", "nenu vastanu repu akkadiki mari neevu ekkada unnavu", 0.35),
])
def test_compression_sees_copies(prompt, response, share):
    assert pair_defects.unexplained(prompt, response) <= share and pair_defects.is_copy(prompt, response)
    assert pair_defects.unexplained(prompt, "bright window paper stone") > 0.8 and not pair_defects.is_copy(prompt, "bright window paper stone")
    assert pair_defects.unexplained("", "x") <= 1 and not pair_defects.is_copy("", "x")


def test_copies_are_decided_by_compression(monkeypatch):
    """A copy with a changed word is a copy, and is none without the compression."""
    p, r = "nenu vastanu repu akkadaki mari neevu ekkada unnavu", "Nenu vastanu repu akkadiki mari neevu ekkada unnavu!"
    assert pair_defects.defect(p, words_of([r])[0]) == "copied"
    monkeypatch.setattr(pair_defects, "unexplained", lambda a, b: 1.0)
    assert pair_defects.defect(p, words_of([r])[0]) != "copied" and pair_defects.defect(p, p) != "copied"


def test_languages(spark):
    assert [pair_defects.language(w.split()) for w in ("నేను వస్తాను bus", "तुम कल", "bright window", "ನೇನು", "ที่", "12", "本を読むことが")] == ["te", "hi", "latin", "kn", "other", None, "ja"]
    df = spark.createDataFrame([(1, "nenu vastanu repu", "तुम कल आओगे क्या"), (2, "nenu", "నేను"), (3, None, None)], "seq bigint, roman_text string, telugu_text string")
    assert [tuple(r) for r in pair_defects.response_languages(df).collect()] == [("hi", 1)] and pair_defects.response_languages(df.limit(0)).count() == 0


def test_alignment_equals_plain_table():
    r = random.Random(12)
    for _ in range(2000):
        whole, said = ("".join(r.choice("abc") for _ in range(r.randint(0, 70))) for _ in range(2))
        row = list(range(len(whole) + 1))
        for i, x in enumerate(said, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(whole, 1):
                last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
        least = min(row)
        assert pair_defects.alignment(whole, said) == (len(row) - 1 - row[::-1].index(least), least)


def _faithful(n, seed):
    r = random.Random(seed)
    words = [("nenu", "నేను"), ("vastanu", "వస్తాను"), ("repu", "రేపు"), ("akkada", "అక్కడ"), ("manchi", "మంచి"), ("illu", "ఇల్లు"), ("pustakam", "పుస్తకం"), ("bus", "bus"), ("chaala", "చాలా"), ("meeru", "మీరు")]
    picks = [[r.choice(words) for _ in range(r.randint(4, 15))] for _ in range(n)]
    return [([a for a, _ in p], [b for _, b in p]) for p in picks]


def test_terminal_model_on_held_out_cuts():
    w = pair_defects.Model(weights=pair_defects.fit_weights(*pair_defects.endings_to_fit(_faithful(300, 1))))
    x, y = pair_defects.endings_to_fit(_faithful(300, 2), seed=5)
    got = 1 / (1 + np.exp(-(x @ np.array(w.weights)))) > 0.5
    assert len(y) > 1000 and (got == (y > 0)).mean() > 0.98
    assert pair_defects.fit_weights(*pair_defects.endings_to_fit([])) == pytest.approx(pair_defects.PRIOR)


def test_refusal_phrases_are_learnt(spark):
    """A refusal without a word of the dictionary is known by the phrases it shares with others; phrases of other answers are not learnt."""
    r = random.Random(4)
    prompts = [" ".join(r.choice("vaanaku meelu chettu konda godugu pandu".split()) for _ in range(5)) for _ in range(60)]
    rows = [(i, p, "క్షమించండి మరొక వాక్యం పంపగలరు దయతో") for i, p in enumerate(prompts[:20])] + [(100 + i, p, "ఈ రోజు ఉదయం సూర్యుడు బాగున్నాడు") for i, p in enumerate(prompts[20:40])]
    rows += [(200, prompts[50], "దయచేసి మరొక వాక్యం పంపగలరు దయతో"), (201, prompts[51], "ఈ రోజు ఉదయం సూర్యుడు బాగున్నాడు"), (202, None, None), (203, "", "")]
    df = spark.createDataFrame(rows, "seq bigint, roman_text string, telugu_text string")
    m = pair_defects.learn(df)
    assert "మరొక వాక్యం పంపగలరు" in m.phrases and not any("ఉదయం" in p for p in m.phrases)
    got = {x.seq: x.defect for x in pair_defects.labelled(df).collect()}
    assert got[200] == "refusal" and got[201] is None and got[0] == "refusal" and got[202] == "empty"
    assert pair_defects.learn(df.limit(0)) == pair_defects.Model(weights=pytest.approx(pair_defects.PRIOR))


def test_pack_lane_round_trip():
    r = random.Random(1)
    items = [(i, r.choice("abc"), r.choice([0, 5, 80, 100, 101, 250, r.randint(1, 400)])) for i in range(4000)]
    total = Counter()
    for _, s, t in items:
        total[s] += t
    shares = {s: t / sum(total.values()) for s, t in total.items()}
    got = packing.pack_lane(items, 100, shares, window=16)
    fill, pieces = Counter(), defaultdict(list)
    for i, box, a, b, _ in got:
        fill[box] += b - a
        pieces[i].append((a, b))
    assert max(fill.values()) <= 100 and sorted(pieces) == list(range(4000))
    for i, _, t in items:
        p = sorted(pieces[i])
        assert p[0][0] == 0 and p[-1][1] == t and all(x[1] == y[0] for x, y in zip(p, p[1:])) and (len(p) == 1 or t > 100)
    assert sum(fill.values()) / (100 * len(fill)) > 0.97
    window_of = {box: w for _, box, _, _, w in got}
    assert all(window_of[box] == w for _, box, _, _, w in got) and sorted(window_of.values()) == [window_of[box] for box in sorted(window_of)]
    assert max(Counter(window_of.values()).values()) <= 18


def test_windows_keep_shares_of_long_texts():
    r = random.Random(3)
    items = [(i, s, t) for i, (s, t) in enumerate([("long", r.randint(300, 3000)) for _ in range(300)] + [("short", r.randint(1, 100)) for _ in range(6000)])]
    r.shuffle(items)
    source = {i: s for i, s, _ in items}
    total = Counter()
    for _, s, t in items:
        total[s] += t
    shares = {s: t / sum(total.values()) for s, t in total.items()}
    got = packing.pack_lane(items, 100, shares, window=64)
    assert sum(b - a for _, _, a, b, _ in got if b - a == 100) > sum(total.values()) / 2
    windows = defaultdict(Counter)
    for i, _, a, b, w in got:
        windows[w][source[i]] += b - a
    full = [c for c in windows.values() if sum(c.values()) > 0.9 * 64 * 100]
    assert len(full) > 20 and all(abs(c[s] / sum(c.values()) - shares[s]) < 0.03 for c in full for s in shares)


@pytest.mark.parametrize("sizes", [[70], [100, 1], [51, 50, 49], [0], [1]])
def test_pack_lane_ends(sizes):
    """Items that fit badly, or are empty, are each packed once, without endless returns to the queues."""
    items = [(i, "ab"[i % 2], sizes[i % len(sizes)]) for i in range(3000)]
    got = packing.pack_lane(items, 100, {"a": 1.0}, window=16)
    assert sorted(g[0] for g in got) == list(range(3000))
    fill = Counter()
    for _, box, a, b, _ in got:
        fill[box] += b - a
    assert max(fill.values()) <= 100


def test_targets_are_reached_while_sources_last(spark):
    docs = spark.createDataFrame([(i, "nenu vastanu " * (1 + i % 7), "abc"[i % 3]) for i in range(3000)], "doc_id bigint, text string, source string")
    packs = spark.createDataFrame([("small", 64)], "pack_name string, capacity_tokens bigint")
    targets = spark.createDataFrame([("a", 6.0), ("b", 2.0), ("c", 2.0), ("gone", float("nan")), (None, 0.0)], "source string, target_share double")
    got = packing.packed(docs, packs, targets, window=32).collect()
    by = defaultdict(Counter)
    for r in got:
        by[r.window_id][r.source] += r.token_end - r.token_start
    first = [by[w] for w in sorted(by)][:10]
    assert all(abs(c["a"] / sum(c.values()) - 0.6) < 0.05 and abs(c["b"] / sum(c.values()) - 0.2) < 0.05 for c in first)
    assert {r.doc_id for r in got} == set(range(3000))
    report = packing.mixture_report(docs, packs, window=32, lane_tokens=6000).collect()
    assert report[0].worst < 0.05 and report[0].windows >= report[0].full_windows > 5
    assert packing.mixture_report(docs.limit(0), packs).count() == 0


def test_packed(spark):
    docs = spark.createDataFrame([(1, "a b c " * 400, "x"), (2, None, "x"), (3, "", None), (4, "hello world", "y"), (5, "hello world", "y"), (6, "నేను " * 50, "y")], "doc_id bigint, text string, source string").withColumn("tokens", F.lit(1)).withColumn("lane", F.lit(9))
    packs = spark.createDataFrame([("small", 64), ("big", 8192), ("small", 64), ("bad", 0), (None, 5)], "pack_name string, capacity_tokens bigint")
    sizes = {r.doc_id: r.tokens for r in packing.token_sizes(docs).collect()}
    assert sizes[2] == sizes[3] == 0 and sizes[1] > 1000
    for r in (got := packing.packed(docs, packs, lane_tokens=300).collect()):
        assert 0 <= r.token_start <= r.token_end <= sizes[r.doc_id]
    fill = Counter()
    for r in got:
        fill[r.pack_name, r.container_id] += r.token_end - r.token_start
    assert all(v <= {"small": 64, "big": 8192}[k[0]] for k, v in fill.items())
    for name in ("small", "big"):
        assert Counter(sizes) == Counter({k: sum(r.token_end - r.token_start for r in got if r.pack_name == name and r.doc_id == k) for k in sizes})
    assert packing.packed(docs.limit(0), packs).count() == 0 and packing.packed(docs, packs.limit(0)).count() == 0
    assert packing.pack_report(docs, packs).count() == 2


def test_fm_index():
    r = np.random.default_rng(0)
    for sample in (1, 3, 16):
        for _ in range(15):
            text = r.integers(1, 5, size=int(r.integers(1, 150)))
            index = leakage.FMIndex(text, sample)
            phrases = r.integers(1, 7, size=(30, 3))
            for p, a, b in zip(phrases, *index.search(phrases)):
                assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(len(text) - 2) if (text[i : i + 3] == p).all()]


def test_leaks_equal_brute_force(spark):
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([5, 8, 9, 20, 40])))) for i in range(25)] + [(100, None), (101, "")]
    items.append((102, items[2][1]))
    docs = []
    for i in range(150):
        t = [r.choice(vocabulary + ["zz"]) for _ in range(r.randint(0, 60))]
        for _ in range(r.choice([0, 1, 2])):
            w = (r.choice(items[:25])[1]).split()
            a = r.randrange(len(w))
            p = r.randrange(len(t) + 1)
            t[p:p] = w[a : a + r.choice([7, 8, 12, 40])]
        docs.append((i, ", ".join(t).upper() if i % 3 else "\n".join(t)))
    docs += [(900, None), (901, ""), (902, items[4][1] + " zz " + items[4][1])]
    phrases = defaultdict(set)
    for i, t in items:
        w = words_of([t])[0].split()
        for k in range(len(w) - 7):
            phrases[tuple(w[k : k + 8])].add(i)
    want = {(d, i) for d, t in docs for w in [words_of([t])[0].split()] for k in range(len(w) - 7) for i in phrases.get(tuple(w[k : k + 8]), ())}
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(1)).repartition(3)
    e = spark.createDataFrame(items, "item_id bigint, text string")
    for options in ({}, {"shard_words": 40, "block_words": 60}, {"pass_words": 100, "block_words": 7}):
        got = [tuple(x) for x in leakage.found(d, e, **options).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 30
    for x in leakage.leaks(d, e).collect():
        part = words_of([dict(docs)[x.doc_id]])[0].split()[x.word_start : x.word_end]
        whole = words_of([dict(items)[x.item_id]])[0].split()
        assert len(part) >= 8 and all(tuple(part[k : k + 8]) in {tuple(whole[j : j + 8]) for j in range(len(whole) - 7)} for k in range(len(part) - 7))
        assert words_of([dict(docs)[x.doc_id][x.char_start : x.char_end]])[0].split() == part
    ranges = leakage.removals(d, e).collect()
    assert {(x.doc_id, i) for x in ranges for i in x["items"]} == want
    by = defaultdict(list)
    for x in ranges:
        by[x.doc_id].append((x.char_start, x.char_end))
    assert all(p[1] < q[0] for spans in by.values() for p, q in zip(sorted(spans), sorted(spans)[1:]))
    for i, t in docs:  # nothing that leaks is left
        kept = list(t or "")
        for a, b in by[i]:
            kept[a:b] = "\n" * (b - a)
        for part in "".join(kept).split("\n\n"):
            w = words_of([part])[0].split()
            assert not any(tuple(w[k : k + 8]) in phrases for k in range(len(w) - 7))
    assert leakage.removals(d, e.limit(0)).count() == 0
    assert leakage.found(d.limit(0), e).count() == 0 and leakage.found(d, e.limit(0)).count() == 0
    assert leakage.item_report(d, e).count() == len({i for _, i in want})


def test_word_places():
    for t in ("Ab, c̈d‌e! ½ – నే‍ను x", "", " .. ", "İstanbul ŉ'a ᾳ ﬁ", "a" * 10_000):
        n = len(words_of([t])[0].split())
        got = leakage.word_places(t, n)
        assert len(got) == n and [words_of([t[a:b]])[0] for a, b in got] == words_of([t])[0].split()


MODEL = sentences.Model(frozenset(["s", "dr", "etc", "కి.మీ", "no", "e.g"]), frozenset(["etc"]), frozenset(["అని", "said", "と"]))


@pytest.mark.parametrize(("text", "ocr", "want"), [
    ("One two. Three! Four?! Five", False, ["One two.", "Three!", "Four?!", "Five"]),
    ("Dr. Rao ran 3.5 miles, e.g. No. 7 on v1.2.3.", False, ["Dr. Rao ran 3.5 miles, e.g. No. 7 on v1.2.3."]),
    ("Pens, ink etc. Next one. Ink etc. and so on.", False, ["Pens, ink etc.", "Next one.", "Ink etc. and so on."]),
    ("నేను వచ్చాను.మీరు రండి। 5 కి.మీ. దూరం.", False, ["నేను వచ్చాను.", "మీరు రండి।", "5 కి.మీ. దూరం."]),
    ("“Come. Now!” said Ravi. “Go.” He left.", False, ["“Come. Now!” said Ravi.", "“Go.”", "He left."]),
    ("ఆమె: “రండి. ఇక్కడికి.” నేను వెళ్ళాను.", False, ["ఆమె: “రండి. ఇక్కడికి.”", "నేను వెళ్ళాను."]),
    ("“రండి!” అని చెప్పింది.", False, ["“రండి!” అని చెప్పింది."]),
    ("Wait… what? Well... fine.", False, ["Wait… what?", "Well... fine."]),
    ("Heading\n\n1. First point. More.\n- (All of it.) Next", False, ["Heading", "1. First point.", "More.", "- (All of it.)", "Next"]),
    ("a line\r\nbroken. Here\n\nnext", True, ["a line\r\nbroken.", "Here", "next"]),
    ("本を読む。「花？」と話す！？次", False, ["本を読む。", "「花？」と話す！？", "次"]),
    ("See https://a.example/p.html?v=2 or www.b.example. Mail x.y@b.example now.", False, ["See https://a.example/p.html?v=2 or www.b.example.", "Mail x.y@b.example now."]),
    ("He (R. T. Rao) came. J. K. Roy too.", False, ["He (R. T. Rao) came.", "J. K. Roy too."]),
    ("In the morning's. Next one.", False, ["In the morning's.", "Next one."]),
    ("", False, []), (" \n\t\n ", False, []), ("...", False, ["..."]), (".", False, ["."]), ("morning's ‘ok.’ said he. Bye", False, ["morning's ‘ok.’ said he.", "Bye"]),
])
def test_sentences(text, ocr, want):
    assert [text[a:b] for a, b in sentences.sentence_spans(text, not ocr, MODEL)] == want


NEXT = MODEL._replace(abbreviations=MODEL.abbreviations | {"u.s", "మొ"}, closing=frozenset(["etc", "మొ"]), leading=frozenset(["dr"]), starters=frozenset(["she", "the"]), inner=frozenset(["పుస్తకాలు", "rao"]), collocations=frozenset([("u.s", "army"), ("etc", "board"), ("#", "oktober"), ("no", "the")]))


@pytest.mark.parametrize(("text", "want"), [
    ("She lived in the U.S. She left.", ["She lived in the U.S.", "She left."]), ("The U.S. Army came. The U.S. Rao is here.", ["The U.S. Army came.", "The U.S. Rao is here."]),
    ("Ink etc. Rao came.", ["Ink etc. Rao came."]), ("Ink etc. Board met.", ["Ink etc. Board met."]), ("Ink etc. The end.", ["Ink etc.", "The end."]),
    ("కలం మొ. పుస్తకాలు కొన్నాను. నేను", ["కలం మొ. పుస్తకాలు కొన్నాను.", "నేను"]), ("కలం మొ. నేను", ["కలం మొ.", "నేను"]),
    ("Dr. She came. No. The end.", ["Dr. She came.", "No. The end."]), ("Am 3. Oktober war es. In 1990. Then", ["Am 3. Oktober war es.", "In 1990.", "Then"]), ("A. She came.", ["A. She came."]),
])
def test_sentences_by_next_word(text, want):
    assert [text[a:b] for a, b in sentences.sentence_spans(text, True, NEXT)] == want


def test_learns_next_words(spark):
    r = random.Random(8)
    names, firsts, words = [f"N{chr(97 + i)}{chr(97 + j)}k" for i in range(5) for j in range(5)], ["She", "Then", "Those"], [f"w{chr(97 + i)}{chr(97 + j)}q" for i in range(12) for j in range(12)]
    docs = []
    for i in range(400):
        parts = []
        for _ in range(12):
            s = [r.choice(firsts)] + [r.choice(words) for _ in range(8)]
            s[4:4] = [r.choice(names)] if r.random() < 0.5 else r.choice([["u.s.", "Army"], ["3.", "Oktober"], []])
            parts.append(" ".join(s) + r.choice([".", "!", " u.s."]))
        docs.append((i, " ".join(parts), "s"))
    m = sentences.learn(df := spark.createDataFrame(docs, "doc_id bigint, text string, source string")).pooled
    assert "u.s" in m.abbreviations and m.starters == {"she", "then", "those"} and {("u.s", "army"), ("#", "oktober")} == m.collocations
    assert sentences.sentences(df, m).count() == 400 * 12


def test_small_letter_after_quotation():
    cut = lambda t: [t[a:b] for a, b in sentences.sentence_spans(t, True, MODEL)]
    assert len(cut("She ran. " * 6 + "“Go!” whispered Ravi. Bye.")) == 8 and len(cut("she ran. " * 6 + "“Go!” then Ravi ran. Bye.")) == 9


def test_learns_types_of_small_share(spark):
    r = random.Random(9)
    words = [f"w{chr(97 + i)}{chr(97 + j)}q" for i in range(12) for j in range(12)]
    sentence = lambda: " ".join(["Then"] + [r.choice(words) for _ in range(6)])
    docs = [(i, ". ".join(sentence() for _ in range(40)) + ".", "s") for i in range(1500)]
    docs += [(2000 + i, f"{sentence()} pvt. {r.choice(words)}.", "s") for i in range(10)] + [(3000 + i, f"“{sentence()}.” said {r.choice(words)}. " * 20 + f"“{sentence()}.” Then {r.choice(words)}.", "s") for i in range(40)]
    docs += [(4000 + i, f"“{sentence()}.” replied {r.choice(words)}.", "s") for i in range(8)]
    m = sentences.learn(spark.createDataFrame(docs, "doc_id bigint, text string, source string")).pooled
    assert m.abbreviations == {"pvt"} and m.quotatives == {"said", "replied"}


def test_learns_by_language(spark):
    """A type that is an abbreviation in one language and a word in another is learnt for the one only; where the language is missing, what holds for all counts."""
    r = random.Random(13)
    words = [f"w{chr(97 + i)}{chr(97 + j)}q" for i in range(12) for j in range(12)]
    sentence = lambda *put: " ".join(["Then", *(r.choice(words) for _ in range(4)), *put, *(r.choice(words) for _ in range(3))])
    docs = [(i, ". ".join(sentence("kam.") for _ in range(5)) + ".", "s", "xx") for i in range(80)] + [(100 + i, ". ".join(sentence("kam") for _ in range(5)) + ".", "s", " YY ") for i in range(800)]
    docs += [(2000, "Then waaq kam. Then wabq.", "s", "xx"), (2001, "Then waaq kam. Then wabq.", "s", "yy"), (2002, "Then waaq kam. Then wabq.", "s", None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, lang string")
    m = sentences.learn(df)
    assert m.languages["xx"].abbreviations == {"kam"} and "kam" not in m.pooled.abbreviations and "kam" in m.of("xx").abbreviations and "kam" not in m.of("yy").abbreviations
    never = m._replace(languages={k: v._replace(leading=frozenset(["kam"])) for k, v in m.languages.items()})
    got = Counter(x.doc_id for x in sentences.sentences(df.where("doc_id >= 2000"), never).collect())
    assert got == {2000: 1, 2001: 2, 2002: 2}


def test_last_words_of_lines_are_counted_whole(spark):
    long = "x" * 60 + "."
    df = spark.createDataFrame([(1, f"a b {long}\n{long}\n  {long}  \nc d."), (2, None)], "doc_id bigint, text string")
    got = {(r.kind, r.type): (r.c1, r.c2) for r in sentences._counts(df, "text", "true").collect()}
    assert got["e", "x" * 60] == (3, 0) and got["w", "x" * 60] == (3, 0) and got["e", "d"] == (1, 0)


def test_spans_cover_everything():
    r = random.Random(5)
    for _ in range(3000):
        t = "".join(r.choice("ab .!?…\n“”\"()[]'。「」1)•-\r​") for _ in range(r.randint(0, 40)))
        spans = sentences.sentence_spans(t, r.random() < 0.5, MODEL)
        assert "".join("".join(t[a:b].split()) for a, b in spans) == "".join(t.split())
        assert all(a < b and not t[a].isspace() and not t[b - 1].isspace() for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_learns(spark):
    r = random.Random(6)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    docs = []
    for i in range(300):
        parts = []
        for _ in range(12):
            s = [r.choice(words) for _ in range(8)]
            s.insert(4, r.choice(["dr.", "dr.", "x"]))
            parts.append(r.choice([" ".join(s) + ".", f"“{' '.join(s)}.” spake {s[0]}."]))
        docs.append((i, r.choice([" ", "\n"]).join(parts), "s"))
    docs += [(900, None, None), (901, "", "ocr_scan"), (902, "x" * 100_000, "s")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string").withColumn("type", F.lit(1))
    m = sentences.learn(df).pooled
    assert "dr" in m.abbreviations and m.quotatives == {"spake"} and not m.abbreviations & set(words)
    got = sentences.sentences(df)
    assert got.where("doc_id < 900").count() == 300 * 12 and got.where("doc_id >= 900").count() == 1
    assert sentences.sentences(df.limit(0)).count() == 0
    assert sum(x.documents for x in sentences.sentence_counts(df).collect()) == len(docs)
