"""The corpus queries over the given tables, with their SQL where SQL can express them."""

from __future__ import annotations

from . import bottom_k, crf, filter_audit, gray_index, kneser_ney, license_rules, line_rules, mixing, multi_index, naming, packing, suffix_array, suffix_trees
from .common import table


def op1_kneser_ney(spark, sf):
    return kneser_ney.classify(table(spark, sf, "documents"), table(spark, sf, "labels"), order=kneser_ney.QUERY_ORDER)


def op2_block_naming(spark, sf):
    return naming.exact_groups(table(spark, sf, "documents")).drop("text_hash")


def op3_window_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"))


def op4_word_crf(spark, sf):
    return crf.identify(table(spark, sf, "documents"))


def op5_suffix_trees(spark, sf):
    return suffix_trees.remove_repeats(table(spark, sf, "documents"))


def op6_license_rules(spark, sf):
    return license_rules.scan_licenses(table(spark, sf, "documents")).drop("spans")


def op7_suffix_array(spark, sf):
    return suffix_array.remove_repeats(table(spark, sf, "documents"))


def op8_line_rules(spark, sf):
    return line_rules.line_rules(table(spark, sf, "documents")).drop("host", "text_hash")


def op9_gray_index(spark, sf):
    return gray_index.near_groups(table(spark, sf, "documents")).drop("component_key", "text_hash")


def op10_pareto_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents")).drop("source", "text_hash")


def op11_bottom_k(spark, sf):
    return bottom_k.near_duplicates(table(spark, sf, "documents"))


def op12_filter_audit(spark, sf):
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels")).drop("filter")


def op13_multi_index(spark, sf):
    return multi_index.hard_negatives(table(spark, sf, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_kneser_ney, op2_block_naming, op3_window_packing, op4_word_crf, op5_suffix_trees, op6_license_rules, op7_suffix_array, op8_line_rules,
        op9_gray_index, op10_pareto_mixing, op11_bottom_k, op12_filter_audit, op13_multi_index,
    )
}

WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

ORACLES = {
    "op2_block_naming": rf"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points, sha256(regexp_replace(coalesce(text, ''), '{WHITE}', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)""",
    "op8_line_rules": rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, generate_subscripts(words, 1) AS i, unnest(words) AS word FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS words FROM d)),
g AS (SELECT doc_id, i, [word, lead(word) OVER o, lead(word, 2) OVER o] AS gram FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g WHERE gram[3] IS NOT NULL),
c AS (SELECT doc_id, count(DISTINCT spot) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS spot FROM r WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT doc_id, source, text, line, lower(trim(regexp_replace(line, '{WHITE}+', ' ', 'g'))) AS norm, len(regexp_extract_all(line, '{WORD}')) AS words FROM l),
k2 AS (SELECT * FROM k WHERE words > 0),
hosts AS (SELECT source, count(DISTINCT text) AS host_docs FROM k2 GROUP BY source),
f AS (SELECT k2.source, norm FROM k2 JOIN hosts ON k2.source IS NOT DISTINCT FROM hosts.source GROUP BY k2.source, norm, host_docs
      HAVING count(DISTINCT text) > {line_rules.LINE_DOCS} AND count(DISTINCT text) > host_docs * {line_rules.LINE_SHARE}),
rem AS (SELECT doc_id, sum(words) AS removed FROM k2 JOIN f ON k2.norm = f.norm AND k2.source IS NOT DISTINCT FROM f.source GROUP BY doc_id),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM k2 GROUP BY doc_id),
b AS (SELECT d.doc_id, CAST(len(regexp_extract_all(text, '{WORD}')) AS BIGINT) AS n_words, length(regexp_replace(text, '{WHITE}', '', 'g')) AS word_chars,
             length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(coalesce(removed, 0) AS BIGINT) AS removed_words
      FROM d LEFT JOIN c USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN rem USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND removed_words <= {line_rules.MOST_REMOVED} * n_words AS kept, removed_words FROM b""",
    "op11_bottom_k": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
g AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END)) AS sh FROM d),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM g a JOIN g b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT u, v FROM l UNION SELECT v, u FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.v, r.root FROM r JOIN e ON e.u = r.node WHERE r.root < e.v),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id""",
    "op12_filter_audit": rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
f AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY t) < doc_id AS fe, part, len(w) < 50 AS fa, 100 * len(list_distinct(w)) < 65 * len(w) AS fb,
             100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS fc, regexp_matches(t, '[#$%&*|]') AS fd FROM d),
q AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, concat(CASE WHEN fa THEN 'A' ELSE '' END, CASE WHEN fb THEN 'B' ELSE '' END, CASE WHEN fc THEN 'C' ELSE '' END,
             CASE WHEN fd THEN 'D' ELSE '' END, CASE WHEN fe THEN 'E' ELSE '' END) AS mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f LEFT JOIN q USING (doc_id) GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, CAST(step AS INT) AS step, filter_order[step] AS f, filter_order[1:step - 1] AS before FROM o, range(1, 6) t(step)),
x AS (SELECT part, filter_order, step, f, mask, n, good, toxic, contains(mask, f) AS fails, len(list_intersect(string_split(mask, ''), string_split(before, ''))) > 0 AND mask <> '' AND before <> '' AS gone FROM m, s),
y AS (SELECT part, filter_order, step, f, CAST(coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS BIGINT) AS removed,
             CAST(coalesce(sum(n) FILTER (fails AND gone), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (mask = f), 0) AS BIGINT) AS unique_fails,
             CAST(coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS BIGINT) AS toxic_lost
      FROM x GROUP BY ALL)
SELECT * EXCLUDE (f), CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM y""",
    "op13_multi_index": """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= 5""",
}
