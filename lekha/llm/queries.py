"""Queries of this package for the driver, with SQL where SQL can say the same over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lekha.llm import canonical_dedup, cutoff, leakage, mixing, overlap, packing, pair_defects, related_splits, sentences
from lekha.session import table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    pairs = lambda s, d: table(s, d, "translit_pairs")
    return {
        "p1_found": lambda s, d: overlap.found(pairs(s, d)),
        "p1_report": lambda s, d: overlap.report(pairs(s, d)),
        "p2_found": lambda s, d: canonical_dedup.copies(pairs(s, d)),
        "p2_records": lambda s, d: canonical_dedup.records(pairs(s, d)),
        "p3_mixture": lambda s, d: mixing.mixture(pairs(s, d), table(s, d, "mix_targets")),
        "p3_shares": lambda s, d: mixing.shares(pairs(s, d), table(s, d, "mix_targets")),
        "p4_found": lambda s, d: pair_defects.found(table(s, d, "llm_pairs")),
        "p4_labels": lambda s, d: pair_defects.labelled(table(s, d, "llm_pairs")),
        "p4_languages": lambda s, d: pair_defects.response_languages(table(s, d, "llm_pairs")),
        "p5_found": lambda s, d: cutoff.kept(pairs(s, d), table(s, d, "keep_targets")),
        "p5_cutoffs": lambda s, d: cutoff.cutoffs(pairs(s, d), table(s, d, "keep_targets")),
        "p6_found": lambda s, d: related_splits.found(pairs(s, d)),
        "p6_splits": lambda s, d: related_splits.splits(pairs(s, d), table(s, d, "split_shares")),
        "p6_report": lambda s, d: related_splits.split_report(related_splits.splits(pairs(s, d), table(s, d, "split_shares")), table(s, d, "split_shares")),
        "p7_packed": lambda s, d: packing.packed(table(s, d, "documents"), table(s, d, "pack_sizes")),
        "p7_report": lambda s, d: packing.pack_report(table(s, d, "documents"), table(s, d, "pack_sizes")),
        "p7_mixture": lambda s, d: packing.mixture_report(table(s, d, "documents"), table(s, d, "pack_sizes")),
        "p8_found": lambda s, d: leakage.found(table(s, d, "documents"), table(s, d, "eval_items")),
        "p8_items": lambda s, d: leakage.item_report(table(s, d, "documents"), table(s, d, "eval_items")),
        "p8_removals": lambda s, d: leakage.removals(table(s, d, "documents"), table(s, d, "eval_items")),
        "p9_found": lambda s, d: sentences.sentences(table(s, d, "documents")),
        "p9_sources": lambda s, d: sentences.sentence_counts(table(s, d, "documents")),
    }


_P5_RANKED = """
WITH t AS (SELECT lower(trim(source_name)) AS src, max(CAST(keep_pct AS DOUBLE)) AS pct FROM keep_targets WHERE trim(source_name) <> '' AND keep_pct IS NOT NULL GROUP BY 1),
r AS (SELECT lower(trim(source_name)) AS src, seq, quality_score AS x FROM translit_pairs WHERE source_name IS NOT NULL AND quality_score IS NOT NULL AND NOT isnan(quality_score)),
c AS (SELECT src, x, count(*) AS c FROM r GROUP BY 1, 2),
k AS (SELECT src, x, sum(c) OVER (PARTITION BY src ORDER BY x DESC) AS cum, sum(c) OVER (PARTITION BY src) AS n FROM c),
f AS (SELECT t.src, t.pct, max(k.x) AS cutoff, min(k.cum) AS kept, max(k.n) AS n FROM t JOIN k ON k.src = t.src AND k.cum >= ceil(t.pct * k.n / 100) GROUP BY 1, 2)
"""




# letters, marks and digits of a text, without case and encoding differences
_LETTERS = "regexp_replace(lower(nfc_normalize(coalesce({}, ''))), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', '', 'g')"
_TE_COUNT = "length(regexp_replace(coalesce({}, ''), '[^ఀ-౿]', '', 'g'))"
_SIDES = f"""s0 AS (SELECT *, {_TE_COUNT.format('roman_text')} > {_TE_COUNT.format('telugu_text')} AS turned FROM translit_pairs),
s1 AS (SELECT *, {_LETTERS.format('CASE WHEN turned THEN roman_text ELSE telugu_text END')} AS te, {_LETTERS.format('CASE WHEN turned THEN telugu_text ELSE roman_text END')} AS ro FROM s0)"""

_P6 = f"""WITH RECURSIVE {_SIDES},
k AS (SELECT seq, te, lower(trim(source_name)) || chr(30) || doc_key AS d FROM s1),
f AS (SELECT seq, min(seq) OVER (PARTITION BY te) AS t1, CASE WHEN d IS NOT NULL THEN min(seq) OVER (PARTITION BY d) END AS d1 FROM k),
e AS MATERIALIZED (SELECT seq AS a, t1 AS b FROM f UNION SELECT t1, seq FROM f UNION SELECT seq, d1 FROM f WHERE d1 IS NOT NULL UNION SELECT d1, seq FROM f WHERE d1 IS NOT NULL),
cc(node, label) USING KEY (node) AS (SELECT seq, seq FROM f UNION (SELECT e.b, min(cc.label) FROM cc JOIN e ON e.a = cc.node JOIN recurring.cc c2 ON c2.node = e.b WHERE cc.label < c2.label GROUP BY e.b)),
g AS (SELECT node AS seq, label AS first_seq FROM cc),
w AS (SELECT split_name, sum(share) AS share FROM split_shares WHERE share > 0 AND split_name IS NOT NULL GROUP BY 1),
c AS (SELECT first_seq, arg_min(split_name, -ln((('0x' || substr(md5(split_name || '|0|' || first_seq), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / share) AS split FROM (SELECT DISTINCT first_seq FROM g), w GROUP BY 1),
a AS (SELECT seq, first_seq, split FROM g JOIN c USING (first_seq))
"""

_P3 = """WITH RECURSIVE t AS (SELECT lower(trim(source_name)) AS s, pair_source AS p, sum(target_share) AS share, max(max_repeats) AS cap FROM mix_targets WHERE trim(source_name) <> '' AND pair_source IS NOT NULL GROUP BY 1, 2),
z AS (SELECT lower(trim(source_name)) AS s, pair_source AS p, seq, greatest(coalesce(quality_score, 0.5), 0.01) AS w FROM translit_pairs),
n AS (SELECT s, p, count(*) AS size FROM z GROUP BY 1, 2),
parts AS MATERIALIZED (SELECT row_number() OVER (ORDER BY s, p) AS i, s, p, share, cap, coalesce(size, 0) AS size, coalesce(size, 0) * cap AS room FROM t LEFT JOIN n USING (s, p)),
fill AS (SELECT 0 AS k, i, share, room, share > 0 AS o, 0::DOUBLE AS budget FROM parts
  UNION ALL SELECT k + 1, i, share, room, o AND NOT (hit OR NOT anyhit), CASE WHEN o AND hit THEN room WHEN o AND NOT anyhit THEN share * unit ELSE budget END
  FROM (SELECT *, bool_or(hit) OVER () AS anyhit FROM (SELECT *, o AND room <= share * unit AS hit FROM (SELECT *, ((SELECT count(*) FROM translit_pairs) - sum(CASE WHEN o THEN 0 ELSE budget END) OVER ()) / nullif(sum(CASE WHEN o THEN share ELSE 0 END) OVER (), 0) AS unit FROM fill))) WHERE k < 20),
b0 AS (SELECT i, budget AS exact, floor(budget + 1e-6) AS low FROM fill WHERE k = 20),
b1 AS (SELECT i, low + CASE WHEN row_number() OVER (ORDER BY low - exact, i) <= round(sum(exact) OVER ()) - sum(low) OVER () THEN 1 ELSE 0 END AS budget FROM b0),
plan AS (SELECT s, p, share, cap, size, floor((least(budget, room) + 1e-6) / nullif(size, 0)) AS epochs, least(budget, room) AS budget FROM b1 JOIN parts USING (i)),
ranked AS (SELECT s, p, seq, row_number() OVER (PARTITION BY s, p ORDER BY -ln((('0x' || substr(md5('0|' || seq), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / w, seq) AS place FROM z),
mixed AS (SELECT seq, s AS source_name, p AS pair_source, (epochs + CASE WHEN epochs < cap AND place <= budget - epochs * size THEN 1 ELSE 0 END)::BIGINT AS uses FROM ranked JOIN plan USING (s, p))
"""

_WORDS = "list_filter(regexp_split_to_array(regexp_replace(lower(nfc_normalize(text)), '\\p{{Cf}}+', '', 'g'), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda x: x <> '')"
_PHRASES = "SELECT id, i, concat_ws(' ', w0, w1, w2, w3, w4, w5, w6, w7) AS phrase FROM (SELECT id, i, w AS w0, {leads} FROM (SELECT {id} AS id, unnest(range(0, len(ws))) AS i, unnest(ws) AS w FROM (SELECT {id}, {words} AS ws FROM {table} WHERE text IS NOT NULL))) WHERE w7 IS NOT NULL"
_LEADS = ", ".join(f"lead(w, {k}) OVER (PARTITION BY id ORDER BY i) AS w{k}" for k in range(1, 8))
_P8 = f"WITH d AS ({_PHRASES.format(id='doc_id', table='documents', words=_WORDS.format(), leads=_LEADS)}), q AS ({_PHRASES.format(id='item_id', table='eval_items', words=_WORDS.format(), leads=_LEADS)}), m AS (SELECT DISTINCT d.id AS doc_id, q.id AS item_id, d.i AS at_word FROM d JOIN q USING (phrase))"

_CODES = "array_to_string(list_transform({0}, lambda x: chr(list_position(list_distinct(x1.ws || x2.ws), x)::INTEGER)), '')"
_P1 = f"""WITH {_SIDES.replace("FROM translit_pairs)", "FROM translit_pairs WHERE split IN ('train', 'val', 'test'))")},
b AS (SELECT seq, split, split = 'train' AS tr, lower(trim(source_name)) AS source_name, te, list_filter(regexp_split_to_array(regexp_replace(lower(nfc_normalize(coalesce(CASE WHEN turned THEN roman_text ELSE telugu_text END, ''))), '\\p{{Cf}}+', '', 'g'), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+'), lambda x: x <> '') AS ws FROM s1),
x AS MATERIALIZED (SELECT ws, row_number() OVER () AS id, min(te) AS te, len(ws) AS n, bool_or(tr) AS tr, bool_or(NOT tr) AS ev FROM b WHERE len(ws) >= 6 GROUP BY ws),
o AS (SELECT id, n, tr, ev, word, row_number() OVER (PARTITION BY id, word) AS nth FROM (SELECT id, n, tr, ev, unnest(ws) AS word FROM x)),
c AS (SELECT o1.id AS a, o2.id AS b, greatest(o1.n, o2.n) // 5 AS most FROM o o1 JOIN o o2 ON o1.tr AND o2.ev AND o1.id <> o2.id AND o1.word = o2.word AND o1.nth = o2.nth AND abs(o1.n - o2.n) <= greatest(o1.n, o2.n) // 5 GROUP BY o1.id, o2.id, o1.n, o2.n HAVING count(*) >= greatest(o1.n, o2.n) - greatest(o1.n, o2.n) // 5),
l AS (SELECT x1.ws AS wa, x2.ws AS wb FROM c JOIN x x1 ON x1.id = c.a JOIN x x2 ON x2.id = c.b WHERE x1.te <> x2.te AND levenshtein({_CODES.format("x1.ws")}, {_CODES.format("x2.ws")}) <= most),
f AS (SELECT t.seq AS train_seq, h.seq AS held_seq, 'same' AS kind, h.split, h.source_name FROM b t JOIN b h ON t.tr AND NOT h.tr AND t.te = h.te
  UNION ALL SELECT t.seq, h.seq, 'near', h.split, h.source_name FROM l JOIN b t ON t.tr AND t.ws = l.wa JOIN b h ON NOT h.tr AND h.ws = l.wb)
"""


def oracle_sql() -> dict[str, str]:
    record = f"WITH {_SIDES}, r AS (SELECT seq, min(seq) OVER (PARTITION BY te, ro) AS keep_seq FROM s1)"
    spans = "SELECT *, sum(fresh) OVER (PARTITION BY doc_id, item_id ORDER BY at_word) AS span FROM (SELECT *, CASE WHEN at_word > lag(at_word) OVER v + 8 OR lag(at_word) OVER v IS NULL THEN 1 ELSE 0 END AS fresh FROM m WINDOW v AS (PARTITION BY doc_id, item_id ORDER BY at_word))"
    return {
        "p1_found": _P1 + "SELECT least(train_seq, held_seq) AS seq_a, greatest(train_seq, held_seq) AS seq_b FROM f",
        "p1_report": _P1 + "SELECT split, source_name, count(*) FILTER (kind = 'same') AS same_pairs, count(*) FILTER (kind = 'near') AS near_pairs, count(DISTINCT held_seq) AS held_rows FROM f GROUP BY 1, 2",
        "p2_found": record + " SELECT keep_seq, seq AS copy_seq FROM r WHERE seq <> keep_seq",
        "p2_records": record + " SELECT keep_seq, count(*) AS copies FROM r GROUP BY 1",
        "p3_mixture": _P3 + "SELECT * FROM mixed WHERE uses > 0",
        "p3_shares": _P3
        + ", got AS (SELECT source_name, pair_source, count(*) FILTER (uses > 0) AS rows_distinct, sum(uses) AS uses, max(uses) AS most_uses FROM mixed GROUP BY 1, 2) SELECT s AS source_name, p AS pair_source, share AS target_share, cap AS max_repeats, size AS rows_available, coalesce(rows_distinct, 0) AS rows_distinct, coalesce(uses, 0)::BIGINT AS uses, coalesce(most_uses, 0) AS most_uses, coalesce(uses / sum(uses) OVER (), 0.0) AS share FROM parts LEFT JOIN got ON s = source_name AND p = pair_source",
        "p6_found": _P6 + "SELECT first_seq, seq FROM g WHERE seq <> first_seq",
        "p6_splits": _P6 + "SELECT * FROM a",
        "p6_report": _P6 + "SELECT w.split_name, w.share, coalesce(r, 0) AS rows, coalesce(r, 0) / sum(r) OVER () AS rows_share, coalesce(n, 0) AS groups FROM w LEFT JOIN (SELECT split, count(*) AS r, count(DISTINCT first_seq) AS n FROM a GROUP BY 1) ON split = w.split_name",
        "p8_found": _P8 + " SELECT DISTINCT doc_id, item_id FROM m",
        "p8_items": _P8 + f", x AS (SELECT doc_id, item_id, span, max(at_word) - min(at_word) + 8 AS n FROM ({spans}) GROUP BY 1, 2, 3) SELECT item_id, count(DISTINCT doc_id) AS documents, count(*) AS spans, max(n) AS longest FROM x GROUP BY 1",
        "p5_found": _P5_RANKED + "SELECT r.seq FROM r JOIN f ON f.src = r.src AND r.x >= f.cutoff",
        "p5_cutoffs": _P5_RANKED + "SELECT t.src AS source_name, t.pct AS keep_pct, f.cutoff, CAST(coalesce(f.n, 0) AS BIGINT) AS rows_scored, CAST(coalesce(f.kept, 0) AS BIGINT) AS rows_kept FROM t LEFT JOIN f ON f.src = t.src",
    }
