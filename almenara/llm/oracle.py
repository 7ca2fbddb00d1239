"""DuckDB SQL with the same rows as the queries."""

from almenara.llm.quality_rules import LINE_LIMIT, NGRAM_LIMITS, SYMBOL_LIMIT

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

_BASE32 = " || ".join(
    f"substr('{_ALPHABET}', ((CAST('0x' || substr(h, {5 * g + 1}, 5) AS BIGINT) >> {shift}) & 31)::INT + 1, 1)"
    for g in range(8)
    for shift in (15, 10, 5, 0)
)

_WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS newest FROM p)
SELECT page_id, octet_length(encode(body)) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM w
"""

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


def _windows(n: int) -> str:
    """Windows of n words with whether they repeat an earlier or any other one."""
    joined = " || ' ' || ".join(f"words[k + {i}]" for i in range(n))
    return f"""
g{n} AS (SELECT doc_id, k, {joined} AS g FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - {n - 1})) AS k FROM d WHERE len(words) >= {n})),
m{n} AS (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, g) AS n, row_number() OVER (PARTITION BY doc_id, g ORDER BY k) AS r FROM g{n}),
c{n} AS (SELECT DISTINCT doc_id, k + i AS k FROM m{n}, generate_series(0, {n - 1}) AS s(i) WHERE r > 1),
t{n} AS (SELECT doc_id, sum(length(words[k])) AS chars FROM c{n} JOIN d USING (doc_id) GROUP BY doc_id)"""


_QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.replace('text', "coalesce(text, '')")} AS words FROM documents),
{','.join(_windows(n) for n in NGRAM_LIMITS)},
f5 AS (SELECT doc_id, count(DISTINCT k + i) AS n FROM m5, generate_series(0, 4) AS s(i) WHERE n > 1 GROUP BY doc_id),
l AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS r FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
e AS (SELECT doc_id, count(*) AS n, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS chars FROM l WHERE r > 1 GROUP BY doc_id),
b AS (SELECT doc_id, len(words) AS n_words, CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(e.n, 0) AS n_dup_lines, coalesce(f5.n, 0) AS n_repeat_words, coalesce(e.chars, 0) AS line_chars
  FROM d LEFT JOIN e USING (doc_id) LEFT JOIN f5 USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR line_chars > {LINE_LIMIT} * word_chars OR n_symbols > {SYMBOL_LIMIT} * word_chars
  OR {' OR '.join(f'coalesce(t{n}.chars, 0) > {limit} * word_chars' for n, limit in NGRAM_LIMITS.items())}) AS kept
FROM b {' '.join(f'LEFT JOIN t{n} USING (doc_id)' for n in NGRAM_LIMITS)}
"""

_NEAR = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (SELECT DISTINCT doc_id, list_aggregate(words[k : k + 3], 'string_agg', ' ') AS s FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 3, 1))) AS k FROM d WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM g x JOIN g y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * o.n >= 80 * (p.n + q.n - o.n)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) LEFT JOIN n USING (doc_id)
"""

_SUFFIX = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS g FROM (SELECT doc_id, h, unnest(range(0, n - 399)) AS i FROM d WHERE n >= 400)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM w) WHERE c > 1),
m AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS opens FROM r),
g AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m),
s AS (SELECT doc_id, min(i) AS lo, max(i) + 400 AS hi FROM g GROUP BY doc_id, run),
k AS (SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS a, lo AS b FROM s UNION ALL SELECT doc_id, max(hi), NULL FROM s GROUP BY doc_id),
t AS (SELECT doc_id, string_agg(CASE WHEN b IS NULL THEN substr(h, 2 * a + 1) ELSE substr(h, 2 * a + 1, 2 * (b - a)) END, '' ORDER BY a, b NULLS LAST) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id),
c AS (SELECT doc_id, sum(hi - lo) AS gone, count(*) AS runs FROM s GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(runs, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256, coalesce(gone, 0) > 0 AS has_repeats
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN c USING (doc_id)
"""

_LINES = r"""
WITH l AS (SELECT doc_id, i, line, regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS bare
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
k AS (SELECT doc_id, i, line, translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.*, s.key IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

_MIX = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '|mix') AS code FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 3 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s),
v AS (SELECT *, total - coalesce(sum(cap) OVER o, 0) AS room, sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS weights FROM w
  WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, total, least(CAST(cap AS DOUBLE), max(CAST(room AS DOUBLE) / CAST(weights AS DOUBLE)) OVER () * weight) AS target FROM v),
c AS (SELECT doc_id, d.source, size, source_size, target, total, code, e, e * source_size + sum(size) OVER (PARTITION BY d.source, e ORDER BY code, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1), (2)) AS x(e)),
p AS (SELECT *, CASE WHEN target > 0 THEN upto / target ELSE 0 END AS finish, greatest(least(size, CAST(round(target) AS BIGINT) - (upto - size)), 0) AS part FROM c),
m AS (SELECT *, sum(part) OVER (ORDER BY finish, code, doc_id, size, e ROWS UNBOUNDED PRECEDING) AS mixed FROM p)
SELECT doc_id, size, source_size, target, CAST(sum(greatest(least(part, total - (mixed - part)), 0)) AS BIGINT) AS taken
FROM m GROUP BY doc_id, source, size, source_size, target
"""

_DIVERGE = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 3),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
x AS (SELECT lang, source, term, coalesce(c.n, 0) AS n, k.n AS of_lang FROM (SELECT DISTINCT lang, source FROM d) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
y AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total FROM x),
p AS (SELECT y.lang, source, term, y.n, 1 + 1000000000 * (CAST(y.n AS HUGEINT) + 1) // (total + v) AS p, 1 + 1000000000 * (CAST(of_lang AS HUGEINT) + 1) // (v.n + v) AS q FROM y JOIN v USING (lang)),
a AS (SELECT lang, x.source, y.source AS item FROM (SELECT DISTINCT lang, source FROM d) x JOIN (SELECT DISTINCT lang, source FROM d) y USING (lang) WHERE x.source <> y.source),
b AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
o AS (SELECT lang, source, 'pair' AS part, item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM a LEFT JOIN b USING (lang, source, item)
  UNION ALL SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM o) WHERE part = 'pair' OR rank <= 200
"""

#: crc32 of the decimal doc_id: each byte is mixed in, then eight steps of one bit
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
  lambda i: list_prepend(CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INT), 1)) AS BIGINT), [-1, -1, -1, -1, -1, -1, -1, -1])))),
  lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"""

_PERIODS = rf"""
WITH d AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n, CAST({_CRC} AS BIGINT) AS h FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)),
e AS (SELECT doc_id, w, n, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a, h // 10 AS g FROM d),
f AS (SELECT doc_id, w, n, a, 1 + (n - a) // (3 + g % 8) AS p, unnest(range(n)) AS i FROM e),
t AS (SELECT doc_id, n, i, w[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1] AS word FROM f),
u AS (SELECT doc_id, n, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS five FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
m AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM u x JOIN u y ON x.doc_id = y.doc_id AND x.five = y.five AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
l AS (SELECT doc_id, q, min(i) AS start, count(*) + 4 + q AS length FROM s GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM l WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS k FROM r),
c AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id),
x AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY t.i) AS kept FROM t ANTI JOIN x ON t.doc_id = x.doc_id AND t.i = x.i GROUP BY t.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
  CAST(length * 1000 // period AS BIGINT) AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id) LEFT JOIN b ON b.doc_id = d.doc_id AND b.k = 1
"""

ORACLE: dict[str, str] = {
    "op1_warc": _WARC,
    "op5_near_dup": _NEAR,
    "op6_quality_rules": _QUALITY,
    "op7_suffix_dedup": _SUFFIX,
    "op9_line_dedup": _LINES,
    "op10_mix_sources": _MIX,
    "op11_source_divergence": _DIVERGE,
    "op12_periodic_runs": _PERIODS,
}
