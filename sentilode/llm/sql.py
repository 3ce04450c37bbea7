"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

QUALITY_RULES = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
counted AS (
  SELECT doc_id, text, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, row_number() OVER () AS r, w
  FROM base),
grams AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM counted)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
measured AS (
  SELECT c.*, coalesce(v.n, 0)::BIGINT AS n_repeat_words,
    length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')) AS upper_letters,
    length(text) - length(regexp_replace(text, '\p{{L}}', '', 'g')) AS letters,
    length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines,
    length(text) - length(regexp_replace(text, '[!?]', '', 'g')) AS n_marks
  FROM counted c LEFT JOIN covered v USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_dup_lines > 3 * n_lines
    OR 10 * letters < 6 * word_chars OR 2 * upper_letters > letters OR 10 * n_marks > 3 * n_words) AS kept
FROM measured
"""

MIXING = r"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, source, md5(coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source),
weighted AS (
  SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM totals),
running AS (
  SELECT *,
    sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_size,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_weight
  FROM weighted),
opened AS (SELECT *, cap / weight >= left_size / left_weight AS open FROM running),
targets AS (
  SELECT source, source_size, CASE WHEN open
    THEN (max(CASE WHEN open THEN left_size END) OVER ())::DOUBLE * weight / max(CASE WHEN open THEN left_weight END) OVER ()
    ELSE cap::DOUBLE END AS target
  FROM opened),
placed AS (
  SELECT r.*, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS expected,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || digest), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
ranked AS (
  SELECT *, floor(expected)::BIGINT AS certain, expected - floor(expected) AS p FROM placed),
ordered AS (
  SELECT *, target - certain * source_size AS open_size, (u / (1 - u)) / (p / (1 - p)) AS odds FROM ranked),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id, size, digest ROWS UNBOUNDED PRECEDING) AS upto
  FROM ordered)
SELECT doc_id, size, source_size, target,
  (size * (certain + CASE WHEN p > 0 AND upto - size / 2 <= open_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""


def _assigned(number: int) -> str:
    """Nearest centroid of the table c<number> per vector; equally near ones by number."""
    return f"""
far{number} AS (
  SELECT r, c.c, sum((p.x - c.x) * (p.x - c.x))::BIGINT AS distance FROM parts p JOIN c{number} c ON p.d = c.d GROUP BY r, c.c),
a{number} AS (
  SELECT r, c, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY distance, c) AS place FROM far{number}) WHERE place = 1)"""


def _moved(number: int) -> str:
    """The table c<number + 1>: floor of the mean, in integers; centroids without vectors stay."""
    return f"""
m{number} AS (
  SELECT a.c, p.d, sum(p.x)::BIGINT AS s, count(*)::BIGINT AS n FROM parts p JOIN a{number} a ON p.r = a.r GROUP BY a.c, p.d),
c{number + 1} AS (
  SELECT c.c, c.d, CASE WHEN m.n IS NULL THEN c.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
  FROM c{number} c LEFT JOIN m{number} m ON c.c = m.c AND c.d = m.d)"""


CENTROIDS = f"""
WITH whole AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
kept AS (SELECT r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM whole),
parts AS (SELECT r, unnest(v) AS x, unnest(range(1, 65)) AS d FROM kept),
first AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), v) - 1 AS c FROM kept),
c0 AS (SELECT f.c, p.d, p.x FROM first f JOIN parts p ON f.r = p.r WHERE f.c < 16),{_assigned(0)},{_moved(0)},{_assigned(1)},{_moved(1)},{_assigned(2)},{_moved(2)},{_assigned(3)},
names AS (SELECT c, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c3 GROUP BY c),
sums AS (SELECT c, sum(distance)::BIGINT AS cluster_inertia FROM a3 GROUP BY c)
SELECT k.vec_id, a.c::INTEGER AS cluster, a.distance, s.cluster_inertia, (SELECT sum(distance)::BIGINT FROM a3) AS inertia,
  n.centroid_sha256
FROM kept k JOIN a3 a ON k.r = a.r JOIN sums s ON a.c = s.c JOIN names n ON a.c = n.c
"""
