"""DuckDB SQL for the queries that SQL can express; each gives the rows of the query of its name."""

WORDS = r"""
words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
)"""

SUBSTRINGS = f"""
WITH {WORDS.format(text='text')},
windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS s FROM words, unnest(range(1, len(w) - 33)) AS t(i)
),
repeated AS (SELECT doc_id, i FROM windows WHERE s IN (SELECT s FROM windows GROUP BY s HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, p FROM repeated, unnest(range(i, i + 35)) AS t(p)),
places AS (SELECT doc_id, p, w[p] AS word FROM words, unnest(range(1, len(w) + 1)) AS t(p)),
left_over AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN left_over USING (doc_id)
"""

TOP_K = """
WITH whole AS (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.row <> c.row WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored QUALIFY rank <= 10
"""

HARD_NEGATIVES = """
WITH whole AS (
  SELECT row_number() OVER () AS row, vec_id,
         CAST(CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.row, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole a JOIN whole c ON a.row <> c.row WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT row, anchor_id, vec_id AS positive_id, score AS positive_score,
         CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS positive_place
  FROM scored WHERE same QUALIFY positive_place <= 5
)
SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score, positive_place,
       CAST(row_number() OVER (PARTITION BY p.row, positive_place ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM positives p JOIN scored s ON s.row = p.row
  AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
cut AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM cut GROUP BY lang),
phrases AS (
  SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, k, CAST(count(*) AS BIGINT) AS f
  FROM cut, unnest([1, 2, 3]) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i) GROUP BY ALL HAVING count(*) >= 10
),
cuts AS (
  SELECT lang, phrase, f AS a, k, c, string_split(phrase, ' ') AS w
  FROM phrases, unnest(range(1, k)) AS t(c) WHERE k > 1
),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, c, x.f AS l, y.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts
  JOIN phrases x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[:c], ' ')
  JOIN phrases y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[c + 1 :], ' ')
  QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, c) = 1
),
around AS (
  SELECT lang, array_to_string(string_split(phrase, ' ')[i : i + 1], ' ') AS phrase, max(f) AS longer
  FROM phrases, unnest([1, 2]) AS t(i) WHERE k = 3 GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM scored LEFT JOIN around USING (lang, phrase) JOIN totals USING (lang)
WHERE longer IS NULL OR 100 * longer < 50 * a QUALIFY rank <= 2000
"""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR = f"""
WITH RECURSIVE {WORDS.format(text=LOWER)},
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
  FROM words, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, e.b FROM reached r JOIN edges e ON e.a = r.b
),
components AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""


def mix(seed: int) -> str:
    """The mix as window sums: sources fill up in the order of their size per weight."""
    return f"""
WITH {WORDS.format(text='text')},
quality AS (
  SELECT doc_id, avg(CASE quality WHEN 1 THEN 1.0 WHEN 0 THEN 0.5 END) AS quality FROM labels GROUP BY doc_id
),
sized AS (
  SELECT doc_id, source, len(w) AS size, CAST(coalesce(quality, 1.0) AS DOUBLE) AS quality
  FROM documents JOIN words USING (doc_id) LEFT JOIN quality USING (doc_id)
),
sources AS (
  SELECT source, sum(size) AS source_size,
         1.0 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source
),
filling AS (
  SELECT *, sum(source_size) OVER () AS total, row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS place,
         coalesce(sum(3 * source_size) OVER before, 0) AS capped,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free
  FROM sources
  WINDOW before AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (
  SELECT arg_min(CAST((total - capped) / free AS DOUBLE), place) AS level FROM filling
  WHERE CAST((total - capped) / free AS DOUBLE) * weight < 3 * source_size
),
targets AS (
  SELECT source, source_size, least(3.0 * source_size, coalesce(level * weight, 3.0 * source_size)) AS target
  FROM sources, level
),
keyed AS (
  SELECT sized.*, source_size, target,
         -ln((CAST('0x' || substr(md5('{seed}:' || doc_id), 1, 13) AS BIGINT) + 0.5) / pow(2, 52)) / quality AS draw,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
),
summed AS (
  SELECT *, target - epochs * source_size AS rest,
         sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id) AS upto
  FROM keyed
),
told AS (
  SELECT *, CAST(epochs + CASE WHEN rest > 0 AND upto - size / 2 <= rest THEN 1 ELSE 0 END AS BIGINT) AS times
  FROM summed
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, round(target, 6) AS target,
       CAST(size * times AS BIGINT) AS taken, times
FROM told
"""
