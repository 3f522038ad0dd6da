"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

#: Phrase counts from explicit n-grams of every size; every cut scored on its own.
COLLOCATIONS = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM p),
s AS (SELECT lang, words, unnest([1, 2, 3, 4]) AS size FROM w),
g AS (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM s WHERE len(words) >= size),
f AS (
  SELECT lang, size, array_to_string(list_slice(words, i, i + size - 1), ' ') AS phrase, count(*) AS f
  FROM g GROUP BY ALL
),
n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
q AS (SELECT lang, size, phrase, f, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND f >= 30),
k AS (SELECT *, unnest(range(1, size)) AS k FROM q),
c AS (
  SELECT k.lang, k.size, k.phrase, k.f AS a, k.k, x.f AS l, y.f AS r,
         (2000000::HUGEINT * k.f) // (x.f + y.f) AS score
  FROM k
  JOIN f AS x ON x.lang = k.lang AND x.phrase = array_to_string(list_slice(k.words, 1, k.k), ' ')
  JOIN f AS y ON y.lang = k.lang AND y.phrase = array_to_string(list_slice(k.words, k.k + 1, k.size), ' ')
),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM c) AS t WHERE place = 1),
spans AS (
  SELECT u.lang, array_to_string(list_slice(u.words, u.i, u.i + u.m - 1), ' ') AS phrase, u.f
  FROM (
    SELECT v.lang, v.words, v.f, v.m, unnest(range(1, v.size - v.m + 2)) AS i
    FROM (SELECT lang, words, f, size, unnest(range(2, size)) AS m FROM q WHERE size > 2) AS v
  ) AS u
),
longer AS (SELECT lang, phrase, max(f) AS f FROM spans GROUP BY lang, phrase),
kept AS (
  SELECT b.* FROM best AS b LEFT JOIN longer AS o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE o.f IS NULL OR 100::HUGEINT * o.f < 80::HUGEINT * b.a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank::BIGINT AS rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r, n.n::BIGINT AS n, r.score::BIGINT AS score
FROM ranked AS r JOIN n ON n.lang = r.lang WHERE r.rank <= 2000
"""


def oracles() -> dict[str, str]:
    return {"op12_collocations": COLLOCATIONS}
