"""DuckDB SQL for the queries that SQL can express."""

HOST_RULES = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         row_number() OVER () AS k
  FROM documents
),
pos AS (SELECT k, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) > 8),
win AS (SELECT k, i, count(*) OVER (PARTITION BY k, w[i:i+7]) AS c FROM pos),
hit AS (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS j FROM win WHERE c > 1),
rep AS (SELECT k, sum(least(8, coalesce(j - i, 8))) AS n FROM hit GROUP BY k),
lines AS (
  SELECT k, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
),
m AS (
  SELECT d.doc_id, d.source, len(w) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words
  FROM d JOIN lines USING (k) LEFT JOIN rep USING (k)
),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS failed FROM m),
h AS (SELECT source, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS x FROM f GROUP BY source),
p AS (SELECT sum(n) AS dd, sum(x) / sum(n) AS mu, sum(x * x / n) / sum(n) - (sum(x) / sum(n)) ** 2
             - (sum(x) / sum(n)) * (1 - sum(x) / sum(n)) * count(*) / sum(n) AS v FROM h),
q AS (SELECT mu, CASE WHEN v > 0 THEN least(100, greatest(1, mu * (1 - mu) / v - 1)) ELSE 100 END AS s FROM p),
r AS (SELECT source, (x + mu * s) / (n + s) AS rate, mu FROM h, q),
t AS (SELECT source, rate, CASE WHEN rate > mu * (1 + 1e-6) THEN rate / mu ELSE 1.0 END AS strict FROM r)
SELECT f.doc_id, f.n_words::BIGINT AS n_words, f.word_chars::BIGINT AS word_chars, f.n_symbols::BIGINT AS n_symbols,
       f.n_dup_lines::BIGINT AS n_dup_lines, f.n_repeat_words::BIGINT AS n_repeat_words, f.failed AS base_failed,
       NOT f.failed AND t.rate <= 0.5 AND f.n_words >= 20 * t.strict AND 100 * f.n_repeat_words * t.strict <= 30 * f.n_words AS kept
FROM f JOIN t ON f.source IS NOT DISTINCT FROM t.source
"""

FIM = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b, ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS e FROM d),
f AS (SELECT *, least(a, b) AS p, greatest(a, b) AS q, CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 90 THEN 'plain' WHEN e < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
x AS (SELECT *, substring(t, 1, p) AS head, substring(t, p + 1, q - p) AS mid, substring(t, q + 1) AS tail FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || head || '<S>' || tail || '<M>' || mid ELSE '<S>' || tail || '<P>' || head || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM x
"""

#: crc32 as shifts: a number that isn't negative is combined by exclusive or, each -1 shifts by a bit.
TRIE = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'r': r, 'x': x} ORDER BY i) AS l FROM t GROUP BY conv_id),
steps AS (SELECT conv_id, l, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])) AS s FROM own),
crc AS (SELECT conv_id, l, xor(list_reduce(list_concat([4294967295::BIGINT], s), lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) % 4 AS h FROM steps),
made AS (SELECT o.conv_id, list_concat(coalesce(b.l[1:o.h], []), o.l[o.h + 1:]) AS l FROM crc o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
p AS (SELECT conv_id, len(l) AS n, d, l[1:d] AS k FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM made)),
node AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(k[d].x, '[^\x20\x09-\x0D]+')) END AS own,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends FROM p GROUP BY k, d),
kids AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
whole AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (k)),
up AS (SELECT k[1:j] AS k, sum((n_children = 0)::INT) AS leaves, sum(own) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS j FROM whole) GROUP BY 1)
SELECT a.conv_id, a.d::BIGINT AS depth, b.conv_id AS parent_conv_id, a.n_convs, a.n_children, up.leaves::BIGINT AS n_leaves, up.saved::BIGINT AS saved_tokens, a.ends AS ends_sha256
FROM whole a JOIN up USING (k) LEFT JOIN whole b ON a.d > 0 AND b.k = a.k[1:a.d - 1]
"""
