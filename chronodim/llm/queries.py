"""Registered queries of the operators in this subpackage."""

from __future__ import annotations

from chronodim.llm import bpe, chat, decontaminate, lm_pst, nn_descent, prefix_trie, quality, ranked, shard, simhash, suffix_dedup, topk, toxicity

QUERIES = {
    "op1_fm_index_decontamination": decontaminate.query,
    "op2_external_shuffle": shard.query,
    "op3_bpe_chunk_reuse": bpe.query,
    "op4_simhash_byte_index": simhash.query,
    "op5_co_training_quality": quality.query,
    "op6_columnar_top_k": topk.query,
    "op7_ftrl_toxicity": toxicity.query,
    "op8_chat_role_repair": chat.query,
    "op9_suffix_columns": suffix_dedup.query,
    "op10_suffix_tree_lm": lm_pst.query,
    "op11_radix_prefix_trie": prefix_trie.query,
    "op12_limited_accumulators": ranked.query,
    "op13_nn_descent": nn_descent.query,
}
LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

#: DuckDB SQL where it can express a query; the others are tested against
#: brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op1_fm_index_decontamination": f"""WITH
i AS (SELECT item_id, {WORDS} AS w FROM benchmark),
p AS (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS a FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, w[a:a + 12] AS g FROM p),
sizes AS (SELECT DISTINCT len(g) AS n FROM win),
d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
starts AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT rid, a, n, item_id FROM (SELECT rid, a, n, w[a:a + n - 1] AS g FROM starts) JOIN win USING (g)),
pos AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(a, a + n)) AS k FROM (SELECT DISTINCT rid, a, n FROM hit)) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS x FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)""",
    "op6_columnar_top_k": """WITH
v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score FROM v q JOIN v ON v.rid <> q.rid WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5""",
    "op12_limited_accumulators": f"""WITH
d AS (SELECT * FROM (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents) WHERE len(w) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d),
q AS (SELECT item, item_id, t, count(*) AS q FROM (SELECT row_number() OVER () AS item, item_id, unnest({WORDS}) AS t FROM benchmark) GROUP BY ALL),
p AS (SELECT rid, doc_id, n, t, count(*) AS tf FROM (SELECT rid, doc_id, len(w) AS n, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
f AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * max(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY t),
r AS (SELECT item, item_id, doc_id, rid, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM p JOIN q USING (t) JOIN f USING (t), s GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS k FROM r WHERE score > 0)
SELECT item_id, CAST(k AS INTEGER) AS rank, doc_id, score FROM o WHERE k <= 10""",
}
