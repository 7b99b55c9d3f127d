"""DuckDB SQL for the queries that SQL can express."""

from mcqflow.llm import quality_rules

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP8 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20),
h AS (SELECT doc_id, p, md5(array_to_string(w[p:p+19], ' ')) AS k FROM t),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n FROM h),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM r WHERE n > 1),
a AS (SELECT doc_id, list(q) AS gone FROM g GROUP BY doc_id),
x AS (SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
      w, coalesce(gone, []) AS gone FROM d LEFT JOIN a USING (doc_id)),
u AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
v AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM u LEFT JOIN g ON g.doc_id = u.doc_id AND g.q = u.p
      WHERE g.q IS NULL GROUP BY u.doc_id)
SELECT x.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM x LEFT JOIN v USING (doc_id)
"""

OP1 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[p:p+4], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS sh FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b, sh, x.n AS na, y.n AS nb FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE sh * 1000 >= 800 * (x.n + y.n - sh)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
k AS (SELECT a AS doc_id, min(b) AS class_id FROM r GROUP BY a)
SELECT k.doc_id, k.class_id, CAST((SELECT count(*) FROM l WHERE l.a = k.doc_id) AS BIGINT) AS n_links,
  least(k.doc_id, coalesce((SELECT min(l.b) FROM l WHERE l.a = k.doc_id AND l.sh = l.na AND l.sh = l.nb), k.doc_id)) AS copy_of,
  CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles
FROM k LEFT JOIN n USING (doc_id)
"""

OP2 = r"""
WITH c AS (SELECT page_id, nullif(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '') AS host,
  CAST('2024-01-01' AS DATE) + CAST((page_id * 37) % 366 AS INTEGER) AS fetched_at FROM pages),
dom AS (SELECT DISTINCT host, CASE WHEN len(string_split(host, '.')) < 2 THEN host ELSE
  array_to_string(string_split(host, '.')[i:], '.') END AS domain
  FROM (SELECT host, unnest(range(1, greatest(2, len(string_split(host, '.'))))) AS i FROM (SELECT DISTINCT host FROM c WHERE host IS NOT NULL))),
x AS (SELECT DISTINCT domain, md5(domain) AS x FROM dom),
g AS (SELECT domain, ('0x' || x[1])::INT AS d1, ('0x' || x[3])::INT AS d3, ('0x' || x[4])::INT AS d4, ('0x' || x[5])::INT AS d5 FROM x),
e AS (SELECT domain, CAST('2024-01-01' AS DATE) + 8 * d3 AS listed_at, true AS blocks FROM g WHERE d1 < 8
  UNION ALL SELECT domain, CAST('2024-01-01' AS DATE) + (8 * d3 + 30 * (d4 + 1)), false FROM g WHERE d1 < 8
  UNION ALL SELECT domain, CAST('2024-01-01' AS DATE) + 300, true FROM g WHERE d1 < 8 AND d5 >= 8),
u AS (SELECT domain, listed_at, bool_or(blocks) AS blocks FROM e GROUP BY ALL),
k AS (SELECT c.page_id, u.domain, u.listed_at, u.blocks,
  row_number() OVER (PARTITION BY c.page_id ORDER BY length(u.domain) DESC, u.listed_at DESC) AS n
  FROM c JOIN dom USING (host) JOIN u ON u.domain = dom.domain AND u.listed_at <= c.fetched_at)
SELECT c.page_id, c.host, CAST(c.fetched_at AS VARCHAR) AS fetched_at, k.domain AS matched,
       CAST(k.listed_at AS VARCHAR) AS listed_at, coalesce(k.blocks, false) AS blocked
FROM c LEFT JOIN k ON k.page_id = c.page_id AND k.n = 1
"""

OP4 = r"""
WITH tbl AS (SELECT list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v, i FROM range(256) r(i)),
crc_table AS (SELECT list(v ORDER BY i) AS tab FROM tbl),
b AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size,
  list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes FROM documents),
z AS MATERIALIZED (SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
  lambda c, y: xor(c >> 8, tab[(xor(c, y) & 255) + 1]))) AS text_crc32 FROM b, crc_table),
o AS (SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size) - size AS before, sum(size) OVER () AS total FROM z),
s AS (SELECT *, CAST(least(7, ((2 * before + size) * 8) // (2 * total)) AS INTEGER) AS shard FROM o)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s
"""

OP13 = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, unnest(list_zip(w, w[2:], w[3:])) AS z FROM w WHERE len(w) > 0),
f AS MATERIALIZED (
  SELECT lang, 1 AS size, z[1] AS phrase, count(*) AS f FROM t GROUP BY ALL
  UNION ALL SELECT lang, 2, z[1] || ' ' || z[2], count(*) FROM t WHERE z[2] IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, z[1] || ' ' || z[2] || ' ' || z[3], count(*) FROM t WHERE z[3] IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS v FROM f WHERE size > 1 AND f >= 10),
k AS (SELECT c.*, k, array_to_string(v[:k], ' ') AS lp, array_to_string(v[k+1:], ' ') AS rp FROM c, (VALUES (1), (2)) AS s(k) WHERE k < size),
x AS (SELECT k.*, g.f AS l, h.f AS r, CAST((1000000::HUGEINT * a * a) // (g.f::HUGEINT * h.f) AS BIGINT) AS score FROM k
  JOIN f g ON g.lang = k.lang AND g.size = k AND g.phrase = lp JOIN f h ON h.lang = k.lang AND h.size = k.size - k AND h.phrase = rp),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
o AS (SELECT lang, part, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(v[1:2], ' ') AS part FROM c WHERE size = 3 UNION ALL
    SELECT lang, a, array_to_string(v[2:3], ' ') FROM c WHERE size = 3) GROUP BY ALL),
d AS (SELECT b.* FROM b LEFT JOIN o ON b.size = 2 AND o.lang = b.lang AND o.part = b.phrase WHERE o.longer IS NULL OR 100 * o.longer < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM d JOIN n USING (lang) QUALIFY rank <= 2000
"""

ORACLE = {"op1_ngram_jaccard_join": OP1, "op2_url_filter": OP2, "op3_quality_rules": quality_rules.oracle_sql(), "op4_sharding": OP4, "op8_substring_dedup": OP8,
          "op13_phrase_collocations": OP13}
