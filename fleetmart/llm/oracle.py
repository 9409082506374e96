"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

_OP1 = """
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id,
    coalesce(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM usable q JOIN usable d ON q.vec_id <> d.vec_id
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id, score
FROM scored
QUALIFY rank <= 10
"""

# Words, their 5-grams as sets, exact Jaccard similarities, links and their closure.
_OP2 = """
WITH RECURSIVE texts AS (
  SELECT text, min(doc_id) AS copy_id, count(*) AS copies,
    regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents WHERE text IS NOT NULL GROUP BY text
), grams AS (
  SELECT DISTINCT copy_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM texts WHERE len(w) > 0
), sizes AS (SELECT copy_id, count(*) AS n FROM grams GROUP BY copy_id
), pairs AS (
  SELECT a.copy_id AS x, b.copy_id AS y, count(*) AS common
  FROM grams a JOIN grams b ON a.g = b.g AND a.copy_id <> b.copy_id
  GROUP BY a.copy_id, b.copy_id
), links AS (
  SELECT x, y FROM pairs JOIN sizes s ON s.copy_id = x JOIN sizes t ON t.copy_id = y
  WHERE common >= 0.8 * (s.n + t.n - common)
), reach(x, y) AS (
  SELECT copy_id, copy_id FROM texts
  UNION
  SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
), classes AS (SELECT x, min(y) AS class_id FROM reach GROUP BY x
), linked AS (
  SELECT x, sum(t.copies) AS n FROM links JOIN texts t ON t.copy_id = links.y GROUP BY x
)
SELECT d.doc_id,
  CASE WHEN s.n IS NULL THEN d.doc_id ELSE t.copy_id END AS copy_id,
  CASE WHEN s.n IS NULL THEN d.doc_id ELSE c.class_id END AS class_id,
  CASE WHEN s.n IS NULL THEN 0 ELSE t.copies - 1 + coalesce(l.n, 0) END::BIGINT AS n_links
FROM documents d
LEFT JOIN texts t ON t.text = d.text
LEFT JOIN sizes s ON s.copy_id = t.copy_id
LEFT JOIN classes c ON c.x = t.copy_id
LEFT JOIN linked l ON l.x = t.copy_id
"""

_ESCAPED = "text"
for _plain, _code in (
    ("~", "~0"), ("</s>", "~1"), ("<s>", "~2"), ("[INST]", "~3"), ("[/INST]", "~4"),
    ("[SYS]", "~5"), ("[/SYS]", "~6"), ("[ROLE]", "~7"), ("[/ROLE]", "~8"), ("[AND]", "~9"),
    ("[TEXT]", "~a"),
):
    _ESCAPED = f"replace({_ESCAPED}, '{_plain}', '{_code}')"

_OP6 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) IS NOT DISTINCT FROM role AS joined
  FROM turns
), marked AS (
  SELECT *, length({_ESCAPED}) + CASE WHEN joined THEN 5 ELSE CASE role
    WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 11
    ELSE 19 + length({_ESCAPED.replace("text", "role")}) END END AS chars
  FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

# Base32 of a SHA-1: every five hex digits are four letters.
_OP9 = """
WITH digests AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), named AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM digests
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
    1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)]), '') AS payload_digest,
  CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM named
"""

ORACLE: dict[str, str] = {
    "op1_topk": _OP1,
    "op2_jaccard": _OP2,
    "op6_chat": _OP6,
    "op9_warc": _OP9,
}
