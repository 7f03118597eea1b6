"""The queries that SQL can express, for DuckDB over the same tables."""

OP1 = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT n FROM win
), grams AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, item_id, i, n FROM grams JOIN win USING (n, s)
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP5 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

OP6 = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), again AS (
  SELECT s FROM windows GROUP BY s HAVING count(*) > 1
), covered AS (
  SELECT DISTINCT doc_id, p
  FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM windows JOIN again USING (s))
), words AS (
  SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k
  FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
), removed AS (
  SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _op12(size: int = 64, clusters: int = 40, rounds: int = 5) -> str:
    """Rounds of centroids, one after the other; all sums are of whole numbers."""
    near = """
a{r} AS MATERIALIZED (
  SELECT id, arg_min(k, (d, k)) AS k, min(d) AS d
  FROM (SELECT v.id, c.k, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
        FROM v, c{r} AS c)
  GROUP BY id
)"""
    move = """
c{s} AS MATERIALIZED (
  SELECT c.k, coalesce(m.x, c.x) AS x
  FROM c{r} AS c LEFT JOIN (
    SELECT k, list(x ORDER BY i) AS x
    FROM (SELECT k, i, CAST(floor_div(sum(x), count(*)) AS BIGINT) AS x
          FROM (SELECT a.k, unnest(v.x) AS x, generate_subscripts(v.x, 1) AS i FROM a{r} AS a JOIN v USING (id))
          GROUP BY k, i)
    GROUP BY k) AS m USING (k)
)"""
    floor_div = "(CAST(sum(x) AS HUGEINT) - ((CAST(sum(x) AS HUGEINT) % count(*)) + count(*)) % count(*)) // count(*)"
    steps = [
        f"""
raw AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
v AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, list_transform(e, lambda y: CAST(floor(256 * y) AS BIGINT)) AS x
  FROM raw
  WHERE len(e) = {size} AND len(list_filter(e, lambda y: y IS NOT NULL AND isfinite(y))) = {size}
)""",
        f"""
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS k, x
  FROM (SELECT sha256('2:' || vec_id) AS h, x FROM v ORDER BY h, x LIMIT {clusters})
)""",
    ]
    for r in range(rounds):
        steps += [near.format(r=r), move.format(r=r, s=r + 1).replace("floor_div(sum(x), count(*))", floor_div)]
    steps.append(near.format(r=rounds))
    return f"""
WITH {",".join(steps)}
SELECT v.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN v USING (id) JOIN c{rounds} AS c USING (k)
"""


OP12 = _op12()
