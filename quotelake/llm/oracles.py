"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
_CONTROL = r"([<\[])(\\*)(\|im_start\|>|\|im_end\|>|/?s>|/?INST\])"

JACCARD = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM words
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM items a JOIN items b USING (t) WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
reach(u, v) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT min(v) FROM reach WHERE u = doc_id) AS component_id FROM sets
"""

TOP_K = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

CHAT = f"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
  SELECT *, length('<|im_start|><|im_end|>') + 2 + length(role) + length(text)
    + len(regexp_extract_all(text, '{_CONTROL}')) AS chars FROM told
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

TREE_MERGE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  row_number() OVER w = 1 AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST)
"""

# CRC-32 from its table, which is made from the polynomial; words are hashed once each.
RESAMPLING = r"""
WITH RECURSIVE steps(i, k, c) AS (
  SELECT i, 0, i FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
wanted AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
held AS (SELECT doc_id, unnest(w) AS word FROM docs),
asked AS (SELECT unnest(w) AS word FROM wanted),
words AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM held UNION SELECT word FROM asked)),
hashed AS (
  SELECT word, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
    lambda a, b: xor(t[xor(a & 255, b) + 1], a >> 8)), 4294967295) % 10000 AS bucket
  FROM words, crc_table
),
s AS (SELECT bucket, count(*) AS n FROM held JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM asked JOIN hashed USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS all_s, (SELECT coalesce(sum(n), 0) FROM t) AS all_t),
gains AS (
  SELECT b AS bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (all_s + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (all_t + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM range(10000) r(b) CROSS JOIN totals LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b
),
weights AS (
  SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM held JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id
),
scores AS (
  SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(docs.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (doc_id)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scores)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= (SELECT 10 * count(*) // 100 FROM scores WHERE n_features >= 20) THEN place END AS rank
FROM ranked
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_jaccard_join": JACCARD, "op9_exact_top_k": TOP_K, "op10_chat_format": CHAT,
        "op12_tree_merge_dedup": TREE_MERGE, "op13_target_resampling": RESAMPLING,
    }
