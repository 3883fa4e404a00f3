"""DuckDB statements for the corpus operators that SQL can express."""

from __future__ import annotations

from lodestar.llm.chat import CLOSE, MIDDLE, OPEN
from lodestar.llm.licenses import KNOWN, SPELLINGS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OP1 = r"""
WITH lists AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM lists),
windows AS (
  SELECT doc_id, word, p,
         md5(string_agg(word, ' ') OVER w50) AS h,
         count(*) OVER w50 AS c
  FROM words
  WINDOW w50 AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
lowest AS (
  SELECT h, min(doc_id) AS lowest FROM windows WHERE c = 50 GROUP BY h),
hits AS (
  SELECT w.doc_id, w.word, w.p,
         CASE WHEN w.c = 50 AND w.doc_id > l.lowest THEN 1 ELSE 0 END AS hit
  FROM windows w LEFT JOIN lowest l ON w.h = l.h),
marked AS (
  SELECT doc_id, word, p,
         max(hit) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM hits)
SELECT d.doc_id,
       CAST(count(m.word) AS BIGINT) AS n_words,
       CAST(coalesce(sum(m.gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(m.word, ' ' ORDER BY m.p) FILTER (WHERE m.gone = 0), '')) AS kept_sha256
FROM documents d LEFT JOIN marked m ON d.doc_id = m.doc_id
GROUP BY d.doc_id"""


def _canonical(text: str) -> str:
    text = rf"regexp_replace(lower({text}), '(^|\n)[ \t]*(copyright |\(c\) |©)[^\n]*', chr(10), 'g')"
    for one, other in SPELLINGS:
        text = f"replace({text}, {_text(one)}, {_text(other)})"
    return f"trim(regexp_replace({text}, '[^a-z0-9]+', ' ', 'g'))"


OP4 = f"""
WITH known AS (
  SELECT {_canonical("text")} AS canon, min(license_id) AS license_id
  FROM (VALUES {", ".join(f"({_text(i)}, {_text(t)})" for i, t in KNOWN)}) k(license_id, text) GROUP BY 1),
units AS (
  SELECT doc_id, 'document' AS scope, text AS unit FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT doc_id, 'line' AS scope, unnest(string_split(text, chr(10))) AS unit FROM documents WHERE contains(text, chr(10))),
canonical AS (
  SELECT doc_id, scope, {_canonical("unit")} AS canon FROM units)
SELECT c.doc_id, k.license_id, c.scope, CAST(count(*) AS BIGINT) AS n_found
FROM canonical c JOIN known k ON c.canon = k.canon
WHERE c.canon <> ''
GROUP BY c.doc_id, k.license_id, c.scope"""


def _escaped(text: str) -> str:
    for pattern in (r"(<)(\\*)(/?s>)", r"(\[)(\\*)(/?INST\])"):
        text = rf"regexp_replace({text}, '{pattern}', '\1\\\2\3', 'g')"
    return text


OP6 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length({_escaped("role")}) + length({_escaped("text")}) + {len(OPEN) + len(MIDDLE) + len(CLOSE)} AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM turns),
grown AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM sized),
said AS (
  SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '') AS loss,
         CAST(sum(CASE WHEN role = 'assistant' OR k = n THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
  FROM grown GROUP BY conv_id)
SELECT CAST(conv_id AS BIGINT) AS conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM said"""


_WHOLE_VECTORS = """embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0"""
_SCALED = "list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))"

OP11 = f"""
WITH e AS (
  SELECT vec_id, {_SCALED} AS v FROM embeddings WHERE vec_id IS NOT NULL AND {_WHOLE_VECTORS}),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM scored)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM ranked WHERE k <= 5"""

OP13 = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_SCALED} AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_WHOLE_VECTORS}),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
         CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM e a JOIN e c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
near AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS k FROM scored WHERE same),
ranked AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id,
         p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS k
  FROM near p JOIN scored n ON p.anchor_id = n.anchor_id
  WHERE p.k <= 5 AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE k <= 3"""

QUERIES: dict[str, str] = {"op1_substring_dedup": OP1, "op4_license_scan": OP4, "op6_chat_format": OP6, "op11_exact_topk": OP11, "op13_hard_negatives": OP13}
