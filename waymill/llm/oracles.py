"""SQL for the corpus queries that SQL can express."""

#: Every window of 13 words as text, the least doc_id of each, and the words that no earlier one covers.
SUBSTRING_DEDUP = r"""WITH t AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
 k AS (SELECT doc_id, s, array_to_string(w[s : s + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM t WHERE len(w) >= 13)),
 f AS (SELECT g, min(doc_id) AS m FROM k GROUP BY g),
 c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS p FROM k JOIN f USING (g) WHERE m < doc_id),
 p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM t),
 a AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM p ANTI JOIN c USING (doc_id, p) GROUP BY doc_id)
 SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM t LEFT JOIN a USING (doc_id)"""

#: Every line with its key; keys of 20 code points or more in three documents or more stay in the largest doc_id only.
LINE_DEDUP = r"""WITH l AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(x) AS line, unnest(range(1, len(x) + 1)) AS pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
 f AS (SELECT key, max(doc_id) AS m FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
 d AS (SELECT doc_id, pos, line, m IS NOT NULL AND doc_id <> m AS gone FROM l LEFT JOIN f USING (key))
 SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM d GROUP BY doc_id"""

_FINITE = "embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"


def _whole(scale: int) -> str:
    return f"list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"


def centroid_clusters(count: int = 16, rounds: int = 3, width: int = 64, scale: int = 64) -> str:
    """Every vector against every centroid in every round."""
    away = "list_sum(list_transform(list_zip(e.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [
        f"e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, {_whole(scale)} AS v FROM embeddings WHERE len(embedding) = {width} AND {_FINITE})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS k, v FROM (SELECT v, sha256('1:' || CAST(vec_id AS VARCHAR)) AS h FROM e ORDER BY h NULLS LAST, v LIMIT {count}))",
    ]
    for t in range(rounds + 1):
        steps.append(f"a{t} AS MATERIALIZED (SELECT r, vec_id, v, k, d FROM (SELECT e.r, e.vec_id, e.v, c.k, {away} AS d FROM e, c{t} c) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)")
        if t < rounds:
            steps.append(f"s{t} AS (SELECT k, p, sum(x) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, unnest(range({width})) AS p FROM a{t}) GROUP BY k, p)")
            steps.append(f"c{t + 1} AS MATERIALIZED (SELECT k, coalesce(m, v) AS v FROM c{t} LEFT JOIN (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS m FROM s{t} GROUP BY k) USING (k))")
    return f"WITH {', '.join(steps)} SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} c USING (k)"


def vector_codes(parts: int = 16, entries: int = 64, rounds: int = 2, width: int = 64, scale: int = 256) -> str:
    """Every part against every entry of its codebook in every round; one row of numbers for each component."""
    own = width // parts
    away = " + ".join(f"(x.v[{i}] - b.v[{i}]) * (x.v[{i}] - b.v[{i}])" for i in range(1, own + 1))
    floors = ", ".join(f"CAST((sum(v[{i}]) - ((sum(v[{i}]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)" for i in range(1, own + 1))
    steps = [
        f"e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, len(embedding) = {width} AS fit, {_whole(scale)} AS v FROM embeddings WHERE {_FINITE})",
        f"x AS MATERIALIZED (SELECT r, p, v[p * {own} + 1 : p * {own} + {own}] AS v FROM e, (SELECT unnest(range({parts})) AS p) WHERE fit)",
        f"o AS MATERIALIZED (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS k FROM e WHERE fit QUALIFY k < {entries})",
        "b0 AS MATERIALIZED (SELECT p, k, v FROM x JOIN o USING (r))",
    ]
    for t in range(rounds + 1):
        steps.append(f"a{t} AS MATERIALIZED (SELECT r, p, min(d * {entries} + k) % {entries} AS k, min(d * {entries} + k) // {entries} AS d, any_value(v) AS v FROM (SELECT x.r, x.p, x.v, b.k, {away} AS d FROM x JOIN b{t} b USING (p)) GROUP BY r, p)")
        if t < rounds:
            steps.append(f"b{t + 1} AS MATERIALIZED (SELECT p, k, coalesce(m, v) AS v FROM b{t} LEFT JOIN (SELECT p, k, [{floors}] AS m FROM a{t} GROUP BY p, k) USING (p, k))")
    steps.append(f"z AS (SELECT r, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)")
    steps.append(f"h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM b{rounds})")
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM e LEFT JOIN z USING (r), h"
