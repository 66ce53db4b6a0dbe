"""SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

_WORDS = r"[^\x20\x09-\x0D]+"

TOP_K = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x)))),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, vec_id, score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s) WHERE rank <= 20"""

SUBSTRINGS = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
places AS (SELECT r, CAST(unnest(range(1, len(w) + 1)) AS INTEGER) AS k, unnest(w) AS word FROM d),
windows AS (SELECT r, k, md5(array_to_string(w[k : k + 34], ' ')) AS h FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS k FROM d)),
repeated AS (SELECT r, k FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
marked AS (SELECT p.r, p.k, word, last_value(q.k IGNORE NULLS) OVER (PARTITION BY p.r ORDER BY p.k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last FROM places p LEFT JOIN repeated q ON p.r = q.r AND p.k = q.k),
gone AS (SELECT r, k, word, coalesce(k - last < 35, false) AS gone FROM marked),
kept AS (SELECT r, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY k) FILTER (NOT gone) AS kept FROM gone GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)"""

JACCARD = f"""WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM documents),
s AS MATERIALIZED (SELECT r, md5(array_to_string(w[k : k + 3], ' ')) AS h FROM (SELECT r, w, unnest(range(1, greatest(2, len(w) - 2))) AS k FROM d WHERE len(w) > 0) GROUP BY ALL),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (SELECT a.r AS a, b.r AS b, count(*) AS common FROM s a JOIN s b ON a.h = b.h AND a.r <> b.r GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(o.doc_id) AS component_id FROM d LEFT JOIN n USING (r) JOIN reach ON reach.a = d.r JOIN d o ON o.r = reach.b GROUP BY d.r, d.doc_id, n.n"""

SUFFIXES = """WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
parts AS (SELECT r, doc_id, p, substr(x, 2 * p + 1, 2198) AS part, length(x) // 2 AS n FROM (SELECT *, unnest(range(0, greatest(1, length(x) // 2), 1000)) AS p FROM d)),
places AS (SELECT r, n, p + i AS k, substr(part, 2 * i + 1, 2) AS byte, CASE WHEN p + i + 100 <= n THEN md5(substr(part, 2 * i + 1, 200)) END AS h FROM (SELECT *, unnest(range(0, least(1000, n - p))) AS i FROM parts)),
ranked AS (SELECT r, k, byte, CASE WHEN h IS NOT NULL AND row_number() OVER (PARTITION BY h ORDER BY r, k) > 1 THEN k END AS again FROM places),
gone AS (SELECT r, k, byte, coalesce(k - max(again) OVER (PARTITION BY r ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) < 100, false) AS gone FROM ranked),
spans AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY k), false) AS begins FROM gone),
kept AS (SELECT r, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans, string_agg(byte, '' ORDER BY k) FILTER (NOT gone) AS kept FROM spans GROUP BY r)
SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN kept USING (r)"""

RANKED = r"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
all_ AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
wanted AS (SELECT i, item_id, term, count(*) AS qtf FROM (SELECT i, item_id, unnest(w) AS term FROM q) GROUP BY ALL),
tf AS MATERIALIZED (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
df AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * all_.n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, all_ GROUP BY term, all_.n),
s AS (SELECT i, item_id, r, doc_id, CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * tf.n * all_.n) // all_.l)))) AS BIGINT) AS score FROM wanted JOIN tf USING (term) JOIN df USING (term), all_ GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM s WHERE score > 0) WHERE rank <= 10"""

EXACT = """WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
    row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256 FROM d"""

SQL = {"op4_exact_top_k_search": TOP_K, "op6_substring_dedup": SUBSTRINGS, "op9_ngram_jaccard_join": JACCARD, "op10_suffix_dedup": SUFFIXES, "op11_ranked_lexical_search": RANKED, "op13_exact_dedup": EXACT}
