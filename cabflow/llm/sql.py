"""SQL of those operators that SQL can express."""

#: All pairs of documents that share a shingle; components by closure over the links.
OP4 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id,
         list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
                                      WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                                      ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i+2], ' ')) END) AS shingle
  FROM w
), sizes AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(shingle, '|' ORDER BY shingle)) AS same FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b, y.same AS same_b, x.same <> y.same AS differs
  FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * m >= 90 * (x.n + y.n - m)
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(DISTINCT same_b) AS n FROM links WHERE differs GROUP BY a)
SELECT w.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(least.b, w.doc_id)) AS component_id,
       coalesce(degree.n, 0)::BIGINT AS n_links
FROM w LEFT JOIN sizes ON sizes.doc_id = w.doc_id LEFT JOIN least ON least.a = w.doc_id LEFT JOIN degree ON degree.a = w.doc_id
"""

#: Every window of 13 words with the first document that has it.
OP9 = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), windows AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w
), keyed AS (
  SELECT doc_id, i, array_to_string(ws[i:i+12], ' ') AS words FROM windows
), firsts AS (
  SELECT words, min(doc_id) AS first_id FROM keyed GROUP BY words
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM keyed JOIN firsts USING (words) WHERE first_id < doc_id
), placed AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS words
  FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.words, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

#: All phrases of up to three words, counted as text; HUGEINT for the products.
OP11 = r"""
WITH pieces AS MATERIALIZED (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS MATERIALIZED (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces
), grams AS MATERIALIZED (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i+size-1], ' '))) AS phrase
    FROM w, (VALUES (1), (2), (3)) sizes(size)
  ) GROUP BY ALL
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE size = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS ws FROM grams WHERE f >= 10),
cuts AS (
  SELECT o.lang, o.size, o.phrase, o.f AS a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * o.f * o.f) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM often WHERE size > 1) o
  JOIN often x ON x.lang = o.lang AND x.size = k AND x.phrase = array_to_string(o.ws[1:k], ' ')
  JOIN often y ON y.lang = o.lang AND y.size = o.size - k AND y.phrase = array_to_string(o.ws[k+1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase, size ORDER BY score, k) = 1
), longer AS (
  SELECT lang, inner_phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS inner_phrase FROM often WHERE size = 3
  ) GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN longer ON longer.lang = b.lang AND longer.inner_phrase = b.phrase AND b.size = 2
  WHERE longer.f IS NULL OR 100 * longer.f < 50 * b.a
)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

_KMEANS_START = """
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), dims AS MATERIALIZED (
  SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM kept
), c0 AS MATERIALIZED (
  SELECT n, unnest(v) AS x, generate_subscripts(v, 1) AS d
  FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS n, v FROM kept QUALIFY n < 8)
)"""

_KMEANS_ASSIGN = """, a{i} AS MATERIALIZED (
  SELECT vec_id, arg_min(n, (distance, n)) AS n, min(distance) AS distance
  FROM (SELECT vec_id, n, sum((dims.x - c.x) * (dims.x - c.x)) AS distance FROM dims JOIN c{i} c USING (d) GROUP BY ALL)
  GROUP BY vec_id
)"""

_KMEANS_MOVE = """, c{j} AS MATERIALIZED (
  SELECT c.n, c.d, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT n, d, ((s - ((s % k) + k) % k) // k)::BIGINT AS x
    FROM (SELECT n, d, sum(x) AS s, count(*) AS k FROM a{i} JOIN dims USING (vec_id) GROUP BY ALL)
  ) m ON m.n = c.n AND m.d = c.d
)"""

_KMEANS_END = """
SELECT vec_id, n::INTEGER AS cluster, distance::BIGINT AS distance, (sum(distance) OVER (PARTITION BY n))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha AS centroid_sha256
FROM a{i} JOIN (SELECT n, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS sha FROM c{i} GROUP BY n) USING (n)
"""


def kmeans(rounds: int) -> str:
    """All distances of every round, one relation after the other."""
    steps = [_KMEANS_ASSIGN.format(i=i) + _KMEANS_MOVE.format(i=i, j=i + 1) for i in range(rounds)]
    return _KMEANS_START + "".join(steps) + _KMEANS_ASSIGN.format(i=rounds) + _KMEANS_END.format(i=rounds)


SQL: dict[str, str] = {"op4_jaccard_join": OP4, "op9_suffix_dedup": OP9, "op11_collocations": OP11, "op12_centroids": kmeans(10)}
