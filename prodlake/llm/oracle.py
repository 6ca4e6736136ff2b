"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations


def whole(scale: int) -> str:
    return f"""list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE)))"""


FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

HARD_NEGATIVES = f"""
WITH e AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {whole(256)} AS v
  FROM embeddings WHERE label IS NOT NULL AND {FINITE}
), s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, o.label = a.label AS same,
         CAST(list_inner_product(a.v, o.v) AS BIGINT) AS score
  FROM e a JOIN e o ON o.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score,
         CAST(row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS INTEGER) AS positive_rank
  FROM s WHERE same QUALIFY positive_rank <= 5
)
SELECT p.anchor_id, p.positive_id, p.positive_rank,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_rank ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""


def vector_codes(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, part, v, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT x.rid, x.part, x.v, c.entry,
           list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, c.v) + list_inner_product(c.v, c.v) AS d
    FROM x JOIN c{i} c ON c.part = x.part)
  GROUP BY rid, part, v
)""")
        if i < rounds:
            steps.append(f"""m{i} AS (
  SELECT part, entry, spot, floor(sum(component) / count(*)) AS component FROM (
    SELECT part, entry, unnest(range(1, len(v) + 1)) AS spot, unnest(v) AS component FROM a{i})
  GROUP BY part, entry, spot
), c{i + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, coalesce(n.v, c.v) AS v
  FROM c{i} c LEFT JOIN (SELECT part, entry, list(component ORDER BY spot) AS v FROM m{i} GROUP BY part, entry) n
    ON n.part = c.part AND n.entry = c.entry
)""")
    return f"""
WITH e AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS rid, vec_id, label, {whole(1024)} AS v FROM embeddings WHERE {FINITE}
), x AS MATERIALIZED (
  SELECT rid, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS v
  FROM e CROSS JOIN (SELECT unnest(range({parts})) AS part)
), c0 AS MATERIALIZED (SELECT part, rid AS entry, v FROM x WHERE rid < {entries}), {", ".join(steps)},
codes AS MATERIALIZED (
  SELECT rid, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY rid
), digest AS (
  SELECT sha256(string_agg(CAST(CAST(component AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, spot)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(range(len(v))) AS spot, unnest(v) AS component FROM c{rounds})
)
SELECT e.vec_id, codes.code, codes.error,
       CAST(sum(codes.error) OVER (PARTITION BY e.label) AS BIGINT) AS label_error, digest.codebooks_sha256
FROM e JOIN codes USING (rid) CROSS JOIN digest
"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


JACCARD_JOIN = rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, {words(r"[^\x20\x09-\x0D]+")} AS w FROM documents
), s AS MATERIALIZED (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')))) END AS shingles
  FROM d
), c AS MATERIALIZED (
  SELECT shingles, row_number() OVER () AS cls, len(shingles) AS n, first_id FROM (
    SELECT shingles, min(doc_id) AS first_id FROM s WHERE len(shingles) > 0 GROUP BY shingles)
), e AS MATERIALIZED (SELECT cls, n, unnest(shingles) AS shingle FROM c),
links AS MATERIALIZED (
  SELECT a.cls AS a, b.cls AS b FROM e a JOIN e b ON a.shingle = b.shingle AND a.cls <> b.cls
  GROUP BY a.cls, b.cls, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(a, b) AS (
  SELECT cls, cls FROM c UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (SELECT reach.a AS cls, min(c.first_id) AS component_id FROM reach JOIN c ON c.cls = reach.b GROUP BY reach.a)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, coalesce(least.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN c ON c.shingles = s.shingles LEFT JOIN least ON least.cls = c.cls
"""

SUFFIX_DEDUP = """
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), w AS MATERIALIZED (
  SELECT rid, spot, hash(substr(h, CAST(2 * spot + 1 AS BIGINT), 800)) AS k
  FROM (SELECT rid, h, unnest(range(n - 399)) AS spot FROM d WHERE n >= 400)
), r AS MATERIALIZED (SELECT rid, spot FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
spans AS MATERIALIZED (
  SELECT rid, min(spot) AS lo, max(spot) + 400 AS hi FROM (
    SELECT rid, spot, sum(fresh) OVER (PARTITION BY rid ORDER BY spot) AS run FROM (
      SELECT rid, spot, CASE WHEN spot - lag(spot, 1, -1000) OVER (PARTITION BY rid ORDER BY spot) > 400 THEN 1 ELSE 0 END AS fresh FROM r))
  GROUP BY rid, run
), kept AS (
  -- what stands before each removed run, and behind the last
  SELECT rid, string_agg(piece, '' ORDER BY lo) AS h, count(*) AS n_spans, sum(size) AS n_removed FROM (
    SELECT spans.rid, lo, hi - lo AS size,
      substr(d.h, CAST(2 * lag(hi, 1, 0) OVER o + 1 AS BIGINT), CAST(2 * (lo - lag(hi, 1, 0) OVER o) AS BIGINT))
      || CASE WHEN lead(hi) OVER o IS NULL THEN substr(d.h, CAST(2 * hi + 1 AS BIGINT)) ELSE '' END AS piece
    FROM spans JOIN d USING (rid) WINDOW o AS (PARTITION BY spans.rid ORDER BY lo))
  GROUP BY rid
)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(kept.n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(kept.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

DECONTAMINATION = rf"""
WITH i AS MATERIALIZED (
  SELECT CAST(item_id AS VARCHAR) AS item, {words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS w FROM benchmark
), iw AS MATERIALIZED (
  SELECT DISTINCT item, size, array_to_string(w[spot : spot + size - 1], ' ') AS window_text FROM (
    SELECT item, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS spot FROM i WHERE len(w) > 0)
), d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, {words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")} AS w FROM documents
), dw AS (
  SELECT rid, size, spot, array_to_string(w[spot : spot + size - 1], ' ') AS window_text FROM (
    SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS spot
    FROM d JOIN (SELECT DISTINCT size FROM iw) ON len(w) >= size)
), hits AS MATERIALIZED (SELECT dw.rid, dw.spot, dw.size, iw.item FROM dw JOIN iw USING (size, window_text)),
counted AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(spot, spot + size)) AS place FROM hits) GROUP BY rid),
named AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN counted USING (rid) LEFT JOIN named USING (rid)
"""
