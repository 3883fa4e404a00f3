"""DuckDB oracle SQL for every query in ``__spark_entry__.queries()``.

the fixture mapping in FIXTURES.md. The driver registers the raw tables as views; each
statement rebuilds the fixture views it needs as CTEs.
"""

from __future__ import annotations

from lodestar.functions.stopwords import ENGLISH


def _sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


STOP = _sql_list(ENGLISH)
RQUOTE = "’"

ENGAGEMENT = """
engagement AS (
  SELECT user_id AS id,
         CAST(count_if(event_type = 'view') AS BIGINT) AS hits,
         CAST(count_if(event_type = 'click') AS BIGINT) AS kudos,
         CAST(1 + count_if(event_type = 'purchase') AS BIGINT) AS chapters,
         CAST(count_if(event_type = 'signup') AS BIGINT) AS comments,
         CAST(count_if(event_type = 'error') AS BIGINT) AS bookmarks
  FROM events GROUP BY user_id)"""

WORKS = ENGAGEMENT + """,
works AS (
  SELECT d.doc_id AS id, substr(d.text, 1, 60) AS title, d.text AS description,
         d.lang AS language, d.source AS authorName,
         CASE WHEN l.doc_id IS NULL THEN [d.lang, d.source]
              ELSE [d.lang, d.source, 'quality_' || CAST(l.quality AS VARCHAR), 'toxic_' || CAST(l.toxic AS VARCHAR)]
         END AS tags,
         coalesce(e.hits, 0) AS hits, coalesce(e.kudos, 0) AS kudos, coalesce(e.chapters, 1) AS chapters,
         coalesce(e.comments, 0) AS comments, coalesce(e.bookmarks, 0) AS bookmarks
  FROM documents d
  LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id
  LEFT JOIN engagement e ON d.doc_id = e.id)"""

SEEDS = """
seeds AS (
  SELECT b.item_id AS id,
         list_filter(list_transform(regexp_split_to_array(b.text, '[.!?\n]'), lambda x: trim(x)), lambda x: x <> '')[1:2] AS titles,
         b.text AS description,
         CASE WHEN p.p_partkey IS NULL THEN []::VARCHAR[] ELSE [p.p_brand] END AS authors,
         CASE WHEN p.p_partkey IS NULL THEN []::VARCHAR[]
              ELSE list_concat(string_split(p.p_name, ' '), [p.p_type, p.p_brand, 'size_' || CAST(p.p_size AS VARCHAR)]) END AS genres,
         CASE WHEN p.p_partkey IS NULL THEN []::VARCHAR[] ELSE [p.p_type, p.p_brand] END AS tags
  FROM benchmark b
  LEFT JOIN (SELECT p_partkey, max(p_name) AS p_name, max(p_brand) AS p_brand, max(p_type) AS p_type, max(p_size) AS p_size
             FROM part GROUP BY p_partkey) p ON b.item_id = p.p_partkey)"""

TITLES = """
titles AS (
  SELECT p_partkey AS idx, [p_name, concat_ws(' ', p_brand, p_type)] AS titles, p_name AS title,
         concat_ws(' ', p_brand, p_type, 'size', CAST(p_size AS VARCHAR)) AS descr
  FROM part)"""

# T1 tokens, stop words removed; A1 postings; A3-A5 over the works relation {W}.
INDEX_T = f"""
wtok AS (
  SELECT id AS doc_id, unnest(regexp_extract_all(lower(description), '[a-z]+')) AS term FROM {{W}}),
postings AS (
  SELECT doc_id, term, count(*) AS tf FROM wtok WHERE term NOT IN ({STOP}) GROUP BY doc_id, term),
ndocs AS (SELECT count(*) AS n FROM {{W}}),
dfs AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
idf AS (
  SELECT term, df, log2(n / (1 + df)) AS idf FROM dfs, ndocs
  WHERE df >= 10 AND df / n <= 0.95),
weights AS (SELECT p.doc_id, p.term, p.tf, i.idf FROM postings p JOIN idf i ON p.term = i.term),
norms AS (SELECT doc_id, sqrt(sum(pow(tf * idf, 2))) AS norm FROM weights GROUP BY doc_id)"""
INDEX = INDEX_T.replace("{W}", "works")
INDEX_KEPT = INDEX_T.replace("{W}", "kept")

QUERY_SIDE = f"""
stok AS (
  SELECT DISTINCT id AS seed_id, unnest(regexp_extract_all(lower(description), '[a-z]+')) AS term FROM seeds),
qterms AS (
  SELECT s.seed_id, s.term, 1 AS qtf, i.idf FROM stok s JOIN idf i ON s.term = i.term
  WHERE s.term NOT IN ({STOP})),
qnorms AS (SELECT seed_id, sqrt(sum(pow(qtf * idf, 2))) AS qnorm FROM qterms GROUP BY seed_id),
matches AS (
  SELECT q.seed_id, w.doc_id, w.term, w.tf * w.idf * q.qtf * w.idf AS contrib
  FROM qterms q JOIN weights w ON q.term = w.term),
dots AS (SELECT seed_id, doc_id, sum(contrib) AS dot FROM matches GROUP BY seed_id, doc_id),
scores AS (
  SELECT d.seed_id, d.doc_id, round(d.dot / (q.qnorm * n.norm), 6) AS score, d.dot / (q.qnorm * n.norm) AS cosine
  FROM dots d JOIN qnorms q ON d.seed_id = q.seed_id JOIN norms n ON d.doc_id = n.doc_id
  WHERE q.qnorm * n.norm > 0),
ranked AS (
  SELECT seed_id, doc_id, score, cosine,
         CAST(row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, doc_id) AS BIGINT) AS rank
  FROM scores),
top AS (SELECT * FROM ranked WHERE rank <= 50),
kw_ranked AS (
  SELECT m.seed_id, m.doc_id, m.term,
         row_number() OVER (PARTITION BY m.seed_id, m.doc_id ORDER BY round(m.contrib, 6) DESC, m.term) AS kr
  FROM matches m SEMI JOIN top t ON m.seed_id = t.seed_id AND m.doc_id = t.doc_id),
kw AS (
  SELECT seed_id, doc_id, string_agg(term, ',' ORDER BY kr) AS keywords
  FROM kw_ranked WHERE kr <= 5 GROUP BY seed_id, doc_id),
recs AS (
  SELECT t.seed_id, t.doc_id, t.rank, t.score, k.keywords, t.cosine
  FROM top t JOIN kw k ON t.seed_id = k.seed_id AND t.doc_id = k.doc_id)"""

TAGS = f"""
corpus AS (
  SELECT 'seed' AS side, id, titles[1] AS title, tags FROM seeds
  UNION ALL
  SELECT 'work' AS side, id, title, tags FROM works),
ctoks AS (
  SELECT side, id,
         list_distinct(list_filter(string_split(lower(array_to_string(tags, '%')), '%'),
                                   lambda x: x <> '' AND x NOT IN ({STOP}))) AS toks
  FROM corpus),
tag_df AS (
  SELECT tag, count(*) AS df FROM (SELECT unnest(toks) AS tag FROM ctoks) GROUP BY tag
  HAVING count(*) >= 0.005 * (SELECT count(*) FROM corpus) AND count(*) <= 0.95 * (SELECT count(*) FROM corpus)),
vocab AS (
  SELECT CAST(row_number() OVER (ORDER BY tag) AS BIGINT) AS tag_rank, tag FROM tag_df ORDER BY tag LIMIT 235),
kept AS (
  SELECT * FROM works WHERE id IN (
    SELECT id FROM (SELECT id, lower(unnest(tags)) AS t FROM works) WHERE t IN (SELECT tag FROM vocab)))"""

SERVING = """
works_dim AS (
  SELECT *, CASE WHEN hits > 0 THEN kudos * chapters / hits ELSE 0.0 END AS popularity FROM kept),
maxpop AS (SELECT max(popularity) AS mp FROM works_dim),
lookup AS (SELECT titles[1] AS title, max(id) AS seed_id FROM seeds GROUP BY titles[1])"""


def blend(requests_cte: str) -> str:
    """K3 over a CTE named ``req(request_id, seed_id, popularity_weight)``."""
    return requests_cte.strip("\n") + """,
cand AS (
  SELECT r.request_id, r.seed_id, r.popularity_weight AS w, t.doc_id, t.rank AS cos_rank, t.score, t.keywords,
         coalesce(coalesce(d.popularity, 0.0) / ((SELECT mp FROM maxpop) / 10.0), 0.0) * r.popularity_weight
           + t.cosine * (1.0 - r.popularity_weight) AS blended
  FROM req r JOIN recs t ON r.seed_id = t.seed_id AND t.rank <= 49
  LEFT JOIN works_dim d ON t.doc_id = d.id),
blended AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY request_id ORDER BY round(blended, 6) DESC, cos_rank) AS BIGINT) AS rank
  FROM cand)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


QUERIES: dict[str, str] = {}

# ---------------------------------------------------------------- step 1
QUERIES["tokenize_count"] = _with(WORKS) + f"""
SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens, CAST(len(list_distinct(toks)) AS BIGINT) AS n_distinct,
       md5(array_to_string(toks, ' ')) AS tokens_md5
FROM (SELECT id AS doc_id,
             list_filter(regexp_extract_all(lower(description), '[a-z]+'), lambda x: x NOT IN ({STOP})) AS toks
      FROM works)"""

QUERIES["primary_title"] = _with(SEEDS) + "SELECT id, titles[1] AS primary_title FROM seeds"

QUERIES["popularity"] = _with(WORKS) + """
SELECT id, hits, kudos, chapters, round(CASE WHEN hits > 0 THEN kudos * chapters / hits ELSE 0.0 END, 6) AS popularity
FROM works"""

QUERIES["keyed_load_last_wins"] = """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1"""

QUERIES["union_pages"] = _with(WORKS, SEEDS) + """
SELECT 'seeds' AS page, id, titles[1] AS title FROM seeds
UNION ALL
SELECT 'works' AS page, id, title FROM works"""

QUERIES["index_maps"] = _with(TITLES) + """
SELECT title, max(idx) AS last_idx, min(idx) AS first_idx, count(*) AS n FROM titles GROUP BY title"""

# ---------------------------------------------------------------- step 2
QUERIES["term_frequency"] = _with(WORKS, INDEX) + "SELECT doc_id, term, tf FROM postings"

QUERIES["inverted_index"] = _with(WORKS, INDEX) + """
SELECT term, CAST(floor(doc_id / 1024) AS BIGINT) AS chunk,
       string_agg(CAST(doc_id AS VARCHAR) || ':' || CAST(tf AS VARCHAR), ' ' ORDER BY doc_id) AS postings
FROM postings GROUP BY term, chunk"""

QUERIES["document_frequency"] = _with(WORKS, INDEX) + "SELECT term, df FROM dfs"

QUERIES["idf_log2"] = _with(WORKS, INDEX) + "SELECT term, df, round(idf, 6) AS idf FROM idf"

QUERIES["doc_norm"] = _with(WORKS, INDEX) + "SELECT doc_id, round(norm, 6) AS norm FROM norms"

QUERIES["query_norm"] = _with(WORKS, SEEDS, INDEX, QUERY_SIDE) + "SELECT seed_id, round(qnorm, 6) AS qnorm FROM qnorms"

# ---------------------------------------------------------------- step 3
QUERIES["dot_product"] = _with(WORKS, SEEDS, INDEX, QUERY_SIDE) + """
SELECT seed_id, doc_id, dot FROM (
  SELECT seed_id, doc_id, round(dot, 6) AS dot,
         row_number() OVER (PARTITION BY seed_id ORDER BY round(dot, 6) DESC, doc_id) AS rank
  FROM dots)
WHERE rank <= 50"""

QUERIES["top50_per_seed"] = _with(WORKS, SEEDS, INDEX, QUERY_SIDE) + "SELECT seed_id, doc_id, rank, score, keywords FROM recs"

QUERIES["top50_term_shuffle"] = QUERIES["top50_per_seed"]
QUERIES["top50_block_max"] = QUERIES["top50_per_seed"]

QUERIES["top5_keywords"] = _with(WORKS, SEEDS, INDEX, QUERY_SIDE) + "SELECT seed_id, doc_id, keywords FROM recs"

E1 = _with(WORKS, SEEDS, TAGS, INDEX_KEPT, QUERY_SIDE, SERVING)

QUERIES["build_recommendations"] = E1 + "SELECT seed_id, doc_id, rank, score, keywords FROM recs"

# ---------------------------------------------------------------- step 4
BLEND_REQ = """
req AS (
  SELECT s.id AS seed_id, s.id * 3 + w.i AS request_id, w.wt AS popularity_weight
  FROM seeds s, (VALUES (0, CAST(0.0 AS DOUBLE)), (1, CAST(0.5 AS DOUBLE)), (2, CAST(1.0 AS DOUBLE))) AS w(i, wt))"""

QUERIES["blend_rerank"] = E1.rstrip("\n") + ",\n" + blend(BLEND_REQ) + """
SELECT request_id, seed_id, w AS popularity_weight, doc_id, rank, cos_rank, round(blended, 4) AS score
FROM blended WHERE rank <= 49"""

RECOMMEND_REQ = """
raw_req AS (
  SELECT id AS request_id, titles[1] AS title, 0.5 AS popularity_weight,
         list_filter(string_split('en,Quality_1,', ','), lambda x: x <> '') AS wanted
  FROM seeds WHERE titles[1] IS NOT NULL),
req AS (SELECT r.request_id, l.seed_id, r.popularity_weight FROM raw_req r JOIN lookup l ON r.title = l.title)"""

QUERIES["recommend"] = E1.rstrip("\n") + ",\n" + blend(RECOMMEND_REQ) + """
SELECT b.request_id, b.rank, b.doc_id AS fanfic_id, d.description, d.title, d.authorName AS author, d.hits, d.kudos,
       array_to_string(d.tags, ',') AS tags, round(b.blended, 4) AS score, b.keywords AS influential_words
FROM blended b JOIN works_dim d ON b.doc_id = d.id JOIN raw_req q ON b.request_id = q.request_id
WHERE b.rank <= 49
  AND (len(q.wanted) = 0 OR len(list_intersect(list_transform(d.tags, lambda t: lower(t)),
                                               list_transform(q.wanted, lambda t: lower(t)))) > 0)"""

QUERIES["tags_any_match"] = _with(WORKS) + """
SELECT id FROM works
WHERE len(list_intersect(list_transform(tags, lambda t: lower(t)), ['en', 'quality_1'])) > 0"""

QUERIES["seed_detail"] = _with(SEEDS) + """,
lookup AS (SELECT titles[1] AS title, max(id) AS seed_id FROM seeds GROUP BY titles[1])
SELECT s0.id AS request_id, l.seed_id, array_to_string(s.titles, '|') AS titles, s.description AS descr,
       s.authors[1] AS author, array_to_string(s.genres[1:4], ',') AS genres
FROM seeds s0 JOIN lookup l ON s0.titles[1] = l.title JOIN seeds s ON s.id = l.seed_id
WHERE s0.titles[1] IS NOT NULL"""

QUERIES["work_tags"] = _with(WORKS) + """
SELECT l.doc_id AS fanfic_id, array_to_string(w.tags, ',') AS tags FROM labels l JOIN works w ON l.doc_id = w.id"""

# ---------------------------------------------------------------- step 5
TITLE_REQUESTS = f"""
treq AS (
  SELECT DISTINCT query FROM (
    SELECT unnest(string_split(p_name, ' ')) AS query FROM part
    UNION ALL SELECT p_brand FROM part
    UNION ALL SELECT p_type FROM part)),
tmatch AS (
  SELECT q.query, t.idx, t.title, t.descr
  FROM treq q JOIN titles t
    ON q.query <> '' AND len(list_filter(t.titles, lambda x: contains(replace(lower(x), '{RQUOTE}', ''''), lower(q.query)))) > 0),
tsearch AS (
  SELECT query, title, arg_min(descr, idx) AS descr, min(idx) AS idx FROM tmatch GROUP BY query, title)"""

QUERIES["title_search"] = _with(TITLES, TITLE_REQUESTS) + "SELECT query, title, descr, idx FROM tsearch"

QUERIES["title_search_top5"] = _with(TITLES, TITLE_REQUESTS) + """
SELECT query, title, idx, pos FROM (
  SELECT query, title, idx, CAST(row_number() OVER (PARTITION BY query ORDER BY idx) AS BIGINT) AS pos FROM tsearch)
WHERE pos <= 5"""

QUERIES["title_search_stored"] = QUERIES["title_search"]

QUERIES["fuzzy_title_search"] = _with(TITLES) + """,
freq AS (
  SELECT substring(p_name, 1, length(p_name) - 1) AS query FROM part
  UNION SELECT reverse(p_brand) FROM part),
scored AS (
  SELECT q.query, t.idx, t.title, CAST(levenshtein(lower(q.query), lower(t.title)) AS BIGINT) AS distance
  FROM freq q, titles t)
SELECT query, rank, idx, title, distance FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY distance, idx) AS BIGINT) AS rank
  FROM scored)
WHERE rank <= 10"""


# ---------------------------------------------------------------- step 6
def _tfidf_counts(rel: str, stop: bool) -> str:
    cond = f"WHERE term NOT IN ({STOP})" if stop else ""
    return f"""(SELECT doc_id, term, count(*) AS tf FROM (
      SELECT id AS doc_id, unnest(regexp_extract_all(lower(description), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM {rel})
    {cond} GROUP BY doc_id, term)"""


QUERIES["tfidf_smooth_l2"] = _with(SEEDS) + f""",
tf AS {_tfidf_counts("seeds", False)},
vocab AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw AS (
  SELECT tf.doc_id, tf.term, tf.tf * (ln((1.0 + (SELECT count(*) FROM seeds)) / (1.0 + v.df)) + 1.0) AS raw
  FROM tf JOIN vocab v ON tf.term = v.term)
SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw"""

QUERIES["tfidf_fold_in"] = _with(SEEDS) + f""",
requests AS (
  SELECT conv_id * 1000 + turn AS id, text AS description FROM conversations WHERE role = 'user'),
fitted AS (SELECT term, count(*) AS df FROM {_tfidf_counts("seeds", False)} GROUP BY term),
raw AS (
  SELECT tf.doc_id, tf.term, tf.tf * (ln((1.0 + (SELECT count(*) FROM seeds)) / (1.0 + v.df)) + 1.0) AS raw
  FROM {_tfidf_counts("requests", False)} tf JOIN fitted v ON tf.term = v.term)
SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw"""

QUERIES["cross_corpus_nearest"] = _with(WORKS, SEEDS) + f""",
both_docs AS (
  SELECT 's' || CAST(id AS VARCHAR) AS id, description FROM seeds
  UNION ALL SELECT 'w' || CAST(id AS VARCHAR) AS id, description FROM works),
tf_both AS {_tfidf_counts("both_docs", True)},
vocab AS (
  SELECT term, ln((1.0 + (SELECT count(*) FROM both_docs)) / (1.0 + count(*))) + 1.0 AS idf FROM tf_both GROUP BY term),
qraw AS (SELECT t.doc_id, t.term, t.tf * v.idf AS raw FROM {_tfidf_counts("seeds", True)} t JOIN vocab v ON t.term = v.term),
draw AS (SELECT t.doc_id, t.term, t.tf * v.idf AS raw FROM {_tfidf_counts("works", True)} t JOIN vocab v ON t.term = v.term),
qv AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS w FROM qraw),
dv AS (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS w FROM draw),
dots AS (
  SELECT q.doc_id AS seed_id, d.doc_id, round(sum(q.w * d.w), 6) AS score
  FROM qv q JOIN dv d ON q.term = d.term GROUP BY q.doc_id, d.doc_id)
SELECT seed_id, doc_id, rank, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, doc_id) AS BIGINT) AS rank FROM dots)
WHERE rank <= 1"""

QUERIES["tag_document_frequency"] = _with(WORKS, SEEDS, TAGS) + "SELECT tag, df FROM tag_df"

QUERIES["tag_vocabulary"] = _with(WORKS, SEEDS, TAGS) + "SELECT tag_rank, tag FROM vocab"

QUERIES["restrict_works_to_tag_vocab"] = _with(WORKS, SEEDS, TAGS) + """
SELECT id FROM works WHERE id IN (
  SELECT id FROM (SELECT id, lower(unnest(tags)) AS t FROM works)
  WHERE t IN (SELECT tag FROM vocab WHERE starts_with(tag, 'src1')))"""

# the sums of powers of all singular values are those of the traces of X'X and (X'X)^2
QUERIES["tag_spectrum_moments"] = _with(WORKS, SEEDS, TAGS) + f""",
toks AS (
  SELECT side, id, unnest(list_filter(string_split(lower(array_to_string(tags, '%')), '%'),
                                      lambda x: x <> '' AND x NOT IN ({STOP}))) AS tag
  FROM corpus),
raw AS (
  SELECT t.side, t.id, t.tag, count(*) * (ln((1.0 + (SELECT count(*) FROM corpus)) / (1.0 + max(f.df))) + 1.0) AS raw
  FROM toks t JOIN tag_df f ON t.tag = f.tag GROUP BY t.side, t.id, t.tag),
x AS (SELECT side, id, tag, raw / sqrt(sum(raw * raw) OVER (PARTITION BY side, id)) AS w FROM raw),
gram AS (SELECT a.tag AS ta, b.tag AS tb, sum(a.w * b.w) AS g FROM x a JOIN x b ON a.side = b.side AND a.id = b.id GROUP BY a.tag, b.tag)
SELECT round((SELECT sum(w * w) FROM x), 4) AS sum_2, round((SELECT sum(g * g) FROM gram), 4) AS sum_4,
       true AS solved, true AS orthonormal"""

# as many triplets as independent rows, 50 at most
QUERIES["singular_triplets"] = _with(SEEDS) + """,
triplets AS (SELECT unnest(range(1, least(50, n) + 1)) AS r FROM (SELECT count(DISTINCT description) AS n FROM seeds))
SELECT CAST(r AS BIGINT) AS rank, true AS solved, true AS orthonormal FROM triplets"""

QUERIES["dense_cosine_topk"] = """
WITH cells AS (
  SELECT label, i, avg(CAST(x AS DOUBLE)) AS x FROM (
    SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY label, i),
cent AS (SELECT label, list(x ORDER BY i) AS c FROM cells GROUP BY label),
vecs AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
scored AS (
  SELECT CAST(c.label AS BIGINT) AS query_id, e.vec_id AS doc_id,
         round(CASE WHEN list_dot_product(c.c, c.c) = 0 OR list_dot_product(e.v, e.v) = 0 THEN 0.0
                    ELSE list_dot_product(c.c, e.v) / (sqrt(list_dot_product(c.c, c.c)) * sqrt(list_dot_product(e.v, e.v))) END, 6) AS score
  FROM cent c, vecs e)
SELECT query_id, doc_id, rank, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS BIGINT) AS rank FROM scored)
WHERE rank <= 5"""

# ---------------------------------------------------------------- step 8
QUERIES["json_pages_roundtrip"] = _with(WORKS) + "SELECT id, title, array_to_string(tags, ',') AS tags, hits FROM works"

QUERIES["bundle_roundtrip"] = QUERIES["build_recommendations"]

QUERIES["catalog_table"] = _with(SEEDS) + """
SELECT CAST(id AS INTEGER) AS id, titles[1] AS title, description AS descr,
       NOT coalesce(length(titles[1]) > 64 OR length(description) > 1024, false) AS stored FROM seeds"""

QUERIES["read_seeds"] = _with(SEEDS) + "SELECT id, CAST(id % 2 AS BIGINT) AS page, titles[1] AS title, description FROM seeds"

QUERIES["batch_from_pages"] = QUERIES["build_recommendations"]

QUERIES["index_maps_both_ways"] = _with(WORKS) + """,
numbered AS (SELECT id, title, row_number() OVER (ORDER BY id) - 1 AS idx FROM works)
SELECT 'id_index' AS map, CAST(id AS VARCHAR) AS key, CAST(idx AS VARCHAR) AS value FROM numbered
UNION ALL SELECT 'index_id', CAST(idx AS VARCHAR), CAST(id AS VARCHAR) FROM numbered
UNION ALL SELECT 'index_title', CAST(idx AS VARCHAR), title FROM numbered
UNION ALL SELECT 'title_index', title, CAST(max(idx) AS VARCHAR) FROM numbered GROUP BY title"""

QUERIES["slider_weight"] = """
SELECT p_partkey, CASE WHEN p_size > 100 THEN 1.0 WHEN p_size < 0 THEN 0.0 ELSE CAST(p_size AS DOUBLE) / 100.0 END::DOUBLE AS weight,
       CAST(NULL AS DOUBLE) AS malformed
FROM part"""

# ---------------------------------------------------------------- step 9
QUERIES["recommend_stream"] = QUERIES["recommend"]

QUERIES["assign_dense_index"] = _with(WORKS) + """
SELECT id, CAST(row_number() OVER (ORDER BY id) - 1 AS BIGINT) AS index FROM works"""

QUERIES["compact_postings"] = QUERIES["inverted_index"]

QUERIES["tokenizer_hook"] = QUERIES["document_frequency"]

QUERIES["assign_input_index"] = _with(WORKS) + """
SELECT id, CAST(row_number() OVER (ORDER BY id % 2, CASE WHEN id % 2 = 0 THEN -id ELSE id % 10 END, id) - 1 AS BIGINT) AS index FROM works"""

QUERIES["score_hook"] = _with(WORKS, SEEDS, INDEX, QUERY_SIDE) + """,
own AS (
  SELECT q.seed_id, w.doc_id, round(sum(w.tf * q.qtf * w.idf), 6) AS score
  FROM qterms q JOIN weights w ON q.term = w.term GROUP BY q.seed_id, w.doc_id)
SELECT seed_id, doc_id, rank, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY seed_id ORDER BY score DESC, doc_id) AS BIGINT) AS rank FROM own)
WHERE rank <= 50"""

QUERIES["read_seeds_split"] = QUERIES["read_seeds"]

QUERIES["restrict_works_whole_vocab"] = _with(WORKS, SEEDS, TAGS) + "SELECT id FROM kept"
