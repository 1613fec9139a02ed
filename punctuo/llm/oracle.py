"""DuckDB SQL of the ``opN_*`` queries that SQL can express on whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op3_curriculum_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight FROM s),
r AS (SELECT *, 2.0::DOUBLE * source_size / weight AS ratio, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS i FROM w),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM r),
f AS (SELECT (SELECT arg_min(level, i) FROM l WHERE level <= ratio) AS water),
t AS (SELECT source, source_size, (i - 0) AS i, weight, coalesce(CASE WHEN ratio <= water THEN 2.0::DOUBLE * source_size ELSE water * weight END,
                                                              2.0::DOUBLE * source_size) AS target,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM l, f),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.turn,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place,
             CAST(round(t.target) AS BIGINT) AS wanted
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, greatest(least(wanted - place, size), 0) AS one, greatest(least(wanted - source_size - place, size), 0) AS two FROM p),
x AS (SELECT *, CASE WHEN one > 0 THEN place WHEN two > 0 THEN place + source_size END AS begins FROM c),
y AS (SELECT *, [[3.75, 3.0, 2.25], [0.75, 1.0, 1.25], [2.0, 2.0, 2.0]][turn + 1] AS v, begins / target * [3.0, 1.0, 2.0][turn + 1] AS y FROM x),
z AS (SELECT *, CASE WHEN y >= (v[1] + v[2]) / 4 THEN 1 ELSE 0 END AS g FROM y),
q AS (SELECT *, CAST(v[1 + g] AS DOUBLE) AS w0, CAST(v[2 + g] AS DOUBLE) AS w1, y - g * CAST(v[1] + v[2] AS DOUBLE) / 4 AS rest FROM z)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(one + two AS BIGINT) AS taken,
       CASE WHEN begins IS NOT NULL THEN round(least(g / 2.0::DOUBLE + CASE WHEN rest > 0 THEN 2 * rest / (w0 + sqrt(greatest(w0 * w0 + 4 * (w1 - w0) * rest, 0))) ELSE 0 END, 1), 6) END AS position
FROM q
"""


def _spans(kind: str, order: int, regex: str, group: int = 0, least: int = 1) -> str:
    """(start, order, end, kind) of one rule's matches: running lengths of the pieces between matches and of the matches."""
    quoted = regex.replace("'", "''")
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{quoted}')) + 1), lambda i: {{
      's': list_sum(list_transform((string_split_regex(t, '{quoted}'))[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform((regexp_extract_all(t, '{quoted}'))[1:i - 1], lambda g: length(g))), 0),
      'o': {order},
      'e': list_sum(list_transform((string_split_regex(t, '{quoted}'))[1:i], lambda g: length(g))) + list_sum(list_transform((regexp_extract_all(t, '{quoted}'))[1:i], lambda g: length(g))),
      'k': '{kind}', 'v': length((regexp_extract_all(t, '{quoted}', {group}))[i])}}), lambda x: x.v >= {least})"""


_RULES = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]{24,}", 0, 24), ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1), ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("google", "AIza[A-Za-z0-9_-]{35}", 0, 1), ("stripe", "(sk|rk)_(live|test)_[A-Za-z0-9]{16,}", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 1), ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
]
_JOINED = "coalesce(list_aggregate(list_transform({}, lambda x: x.k || ':' || CAST(x.s AS BIGINT) || ':' || CAST(x.e AS BIGINT)), 'string_agg', ','), '')"
ORACLE["op10_trigram_secret_scan"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT doc_id, list_sort(list_concat({', '.join(_spans(k, i, r, g, n) for i, (k, r, g, n) in enumerate(_RULES))})) AS s FROM d)
SELECT doc_id, CAST(len(list_filter(s, lambda x: x.k = 'assign')) AS BIGINT) AS n_assign, CAST(len(list_filter(s, lambda x: x.k = 'access')) AS BIGINT) AS n_access,
       CAST(len(list_filter(s, lambda x: x.k = 'hex')) AS BIGINT) AS n_hex, sha256({_JOINED.format('list_filter(s, lambda x: x.o < 3)')}) AS base_sha256,
       {_JOINED.format('s')} AS spans
FROM s
"""

ORACLE["op13_quicksort_collocations"] = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
o AS (
  SELECT lang, 1 AS words, unnest(w) AS phrase FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w WHERE len(w) >= 2
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM w WHERE len(w) >= 3),
f AS (SELECT lang, words, phrase, count(*) AS a FROM o GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, count(*) AS n FROM o WHERE words = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS p FROM f WHERE words > 1),
k AS (SELECT *, unnest(range(1, words)) AS k FROM c),
s AS (
  SELECT k.lang, k.phrase, k.words, k.a, k.p, k.k, x.a AS l, y.a AS r,
         CAST((CAST(1000000 AS HUGEINT) * k.a * k.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.p[1:k.k], ' ')
         JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.p[k.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
h AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, p[1] || ' ' || p[2] AS phrase, a FROM c WHERE words = 3 UNION ALL SELECT lang, p[2] || ' ' || p[3], a FROM c WHERE words = 3)
  GROUP BY ALL),
z AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, b.l, b.r, n.n, b.score
  FROM b JOIN n ON n.lang = b.lang LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase
  WHERE h.longer IS NULL OR 100 * h.longer < 50 * b.a)
SELECT * FROM z WHERE rank <= 2000
"""
