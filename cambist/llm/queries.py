"""The operators as registered queries: whole tables, production parameters."""

from __future__ import annotations

from . import best_fit, codebooks, decontamination, edit_counts, importance, language, licenses, mtree, near_duplicates, packing, repeats, token_files, toxicity
from .shared import table

QUERIES, ORACLES = {}, {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op3_token_files(spark, sf_dir):
    return token_files.encode_to_files(table(spark, sf_dir, "documents"))


@query
def op4_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_near_duplicates(spark, sf_dir):
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


ORACLES["op8_near_duplicates"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) > 1 THEN list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) ELSE w END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
classes AS (
  SELECT min(doc_id) AS cid, any_value(n) AS n, s FROM (SELECT doc_id, len(s) AS n, list_sort(s) AS s FROM sets WHERE len(s) > 0) GROUP BY s),
class_items AS (SELECT cid, n, unnest(s) AS x FROM classes),
ranked AS (
  SELECT i.cid, i.n, i.x, row_number() OVER (PARTITION BY i.cid ORDER BY f.df, i.x) AS r
  FROM class_items i JOIN (SELECT x, count(*) AS df FROM class_items GROUP BY x) f USING (x)),
prefix AS (SELECT cid, n, x FROM ranked WHERE r <= n - ceil(0.8 * n) + 1),
candidates AS (
  SELECT DISTINCT p.cid AS a, q.cid AS b FROM prefix p JOIN prefix q USING (x)
  WHERE p.cid < q.cid AND 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)),
links AS (
  SELECT a, b FROM (
    SELECT c.a, c.b, count(*) AS common, any_value(i.n) + any_value(j.n) AS total
    FROM candidates c JOIN class_items i ON i.cid = c.a JOIN class_items j ON j.cid = c.b AND j.x = i.x GROUP BY c.a, c.b)
  WHERE 100 * common >= 80 * (total - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT cid, cid AS r FROM classes UNION SELECT e.b, reach.r FROM reach JOIN edges e ON e.a = reach.cid),
roots AS (SELECT cid, min(r) AS component_id FROM reach GROUP BY cid),
members AS (
  SELECT t.doc_id, len(t.s) AS n, c.cid FROM (SELECT doc_id, list_sort(s) AS s FROM sets) t LEFT JOIN classes c ON c.s = t.s)
SELECT m.doc_id, CAST(m.n AS BIGINT) AS n_shingles, coalesce(r.component_id, m.doc_id) AS component_id,
  m.doc_id = coalesce(r.component_id, m.doc_id) AS kept
FROM members m LEFT JOIN roots r ON r.cid = m.cid
"""


@query
def op10_repeats(spark, sf_dir):
    return repeats.removal_report(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLES["op10_repeats"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS x
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)),
again AS (SELECT x FROM windows GROUP BY x HAVING count(*) > 1),
gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(i, i + 35)))) AS p FROM windows WHERE x IN (SELECT x FROM again) GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, w.w, coalesce(len(g.p), 0) AS n_removed, p
  FROM words w LEFT JOIN gone g ON g.doc_id = w.doc_id),
flat AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words) s
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(p) AS i FROM gone) g WHERE g.doc_id = s.doc_id AND g.i = s.i) GROUP BY doc_id)
SELECT k.doc_id, CAST(len(k.w) AS BIGINT) AS n_words, CAST(k.n_removed AS BIGINT) AS n_removed, sha256(coalesce(f.t, '')) AS kept_sha256
FROM kept k LEFT JOIN flat f ON f.doc_id = k.doc_id
"""


@query
def op1_decontamination(spark, sf_dir):
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))).drop("text_hash")


@query
def op9_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


@query
def op5_licenses(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query
def op6_top_products(spark, sf_dir):
    return mtree.greatest_products(table(spark, sf_dir, "embeddings"))


ORACLES["op6_top_products"] = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 5
"""


@query
def op7_edited_counts(spark, sf_dir):
    return edit_counts.edited_counts(table(spark, sf_dir, "documents"))


@query
def op11_best_fit(spark, sf_dir):
    return best_fit.pack(table(spark, sf_dir, "documents"))


@query
def op12_importance(spark, sf_dir):
    found = importance.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_vector_codes(spark, sf_dir):
    found = codebooks.compressed(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _vector_codes_sql(rounds=codebooks.ROUNDS) -> str:
    """Assignment as the least of distance * 256 + entry; distances by squared norms and products, exact in doubles."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
best{k} AS MATERIALIZED (
  SELECT x.vec_id, x.row, x.p, min(CAST(x.norm + b.norm - 2 * list_inner_product(x.d, b.d) AS BIGINT) * 256 + b.e) AS m
  FROM parts x JOIN books{k} b USING (p) GROUP BY x.vec_id, x.row, x.p)""")
        if k < rounds:
            steps.append(f"""
books{k + 1} AS MATERIALIZED (
  SELECT o.p, o.e, coalesce(n.c, o.c) AS c, coalesce(n.c, o.c)::DOUBLE[] AS d, list_inner_product(coalesce(n.c, o.c)::DOUBLE[], coalesce(n.c, o.c)::DOUBLE[]) AS norm
  FROM books{k} o LEFT JOIN (
    SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
      SELECT b.p, b.m % 256 AS e, i, sum(x.c[i]) AS s, count(*) AS n
      FROM best{k} b JOIN parts x ON x.row = b.row AND x.p = b.p CROSS JOIN positions GROUP BY b.p, b.m % 256, i) GROUP BY p, e) n
  ON n.p = o.p AND n.e = o.e)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS row,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (SELECT vec_id, row, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS c FROM kept CROSS JOIN (SELECT unnest(range(4)) AS p)),
parts AS MATERIALIZED (SELECT *, c::DOUBLE[] AS d, list_inner_product(c::DOUBLE[], c::DOUBLE[]) AS norm FROM cut),
positions AS (SELECT unnest(range(1, (SELECT max(len(c)) FROM parts) + 1)) AS i),
books0 AS MATERIALIZED (SELECT p, row - 1 AS e, c, d, norm FROM parts WHERE row <= 256),{",".join(steps)},
coded AS (
  SELECT k.vec_id, k.label, string_agg(printf('%02x', b.m % 256), '' ORDER BY b.p) AS code, CAST(sum(b.m // 256) AS BIGINT) AS error
  FROM kept k JOIN best{rounds} b USING (row) GROUP BY k.row, k.vec_id, k.label),
digest AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) AS h FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS i FROM books{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded CROSS JOIN digest
"""


ORACLES["op13_vector_codes"] = _vector_codes_sql()
