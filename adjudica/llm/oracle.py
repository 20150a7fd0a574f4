"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP3_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))) AS k
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source),
total AS (SELECT sum(source_size)::DOUBLE AS s, sum(weight) AS w FROM sources),
rounds AS (
  SELECT 0 AS n, 1.5::DOUBLE * s AS rest, w FROM total
  UNION ALL
  SELECT n + 1, rest2, w2 FROM (
    SELECT r.n, r.rest, r.w,
      1.5::DOUBLE * (SELECT s FROM total) - (SELECT coalesce(sum(2.0::DOUBLE * source_size), 0) FROM sources WHERE weight * r.rest / r.w > 2.0::DOUBLE * source_size) AS rest2,
      (SELECT sum(weight) FROM sources WHERE weight * r.rest / r.w <= 2.0::DOUBLE * source_size) AS w2
    FROM rounds r)
  WHERE w2 IS NOT NULL AND w2 <> w),
final AS (SELECT rest, w FROM rounds ORDER BY n DESC LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN weight * rest / w > 2.0::DOUBLE * source_size THEN 2.0::DOUBLE * source_size ELSE weight * rest / w END AS target
  FROM sources, final),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM targets),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized)
SELECT p.doc_id, p.size, b.source_size, b.target,
       CAST(b.epochs * p.size + least(greatest(CAST(floor(b.target) AS BIGINT) - b.epochs * b.source_size - p.before, 0), p.size) AS BIGINT) AS taken
FROM placed p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source
"""

OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
links AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS reached FROM documents UNION SELECT r.doc_id, links.b FROM r JOIN links ON links.a = r.reached),
c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""

OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5
"""

OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS late FROM documents),
f AS (
  SELECT doc_id, part, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN late THEN 'E' ELSE '' END AS fails FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
h AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
x(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT o, CAST(s AS INTEGER) AS step, substr(o, CAST(s AS INTEGER), 1) AS letter FROM o, range(1, 6) r(s)),
m AS (SELECT h.*, o, coalesce(list_min(list_transform(regexp_extract_all(fails, '.'), lambda c: instr(o, c))), 6) AS first FROM h, o),
r AS (
  SELECT part, s.o AS filter_order, step, letter, sum(CASE WHEN first > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN first = step THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN first < step AND contains(fails, letter) THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN first = step THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN first = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM m JOIN s ON m.o = s.o GROUP BY part, s.o, step, letter)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r
"""


def op6_sql():
    """The model's weights are part of the text, as the driver fits them."""
    from adjudica.llm import url_filter as U

    bias, weights = U.own_model()
    rules = ", ".join(f"('{v}', '{r}', '{r[:r.index('/')]}', '{r[r.index('/'):]}')" for v, r in U.RULES)
    code = "0"
    for k in range(U.GRAM):
        code = f"(({code}) * 131 + unicode(substr(t, CAST(i + {k} AS INTEGER), 1))) % 1000003"
    return rf"""
WITH p AS (SELECT page_id, CASE WHEN coalesce(instr(url, '://'), 0) = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
rules(said, rule, rule_host, rule_path) AS (VALUES {rules}),
m AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said FROM h JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id),
t AS (SELECT *, '^' || host || regexp_replace(path, '[0-9]+', '0', 'g') || '$' AS t FROM h),
w AS (SELECT [{", ".join(map(repr, weights))}]::DOUBLE[] AS w),
g AS (SELECT page_id, host, path, t, list_transform(range(1, length(t) - {U.GRAM} + 2), lambda i: ({code}) % {U.BUCKETS} + 1) AS grams FROM t),
s AS (SELECT page_id, host, path, {bias!r}::DOUBLE + CASE WHEN len(grams) > 0 THEN list_sum(list_transform(grams, lambda k: w[k])) * 10.0::DOUBLE / len(grams) ELSE 0 END AS score FROM g, w)
SELECT s.page_id, host, path, m.rule, coalesce(m.said, CASE WHEN score > 0 THEN 'block' ELSE 'allow' END) AS verdict FROM s LEFT JOIN m USING (page_id)
"""


OP4_SQL = r"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
a AS (
  SELECT doc_id, lang, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS solid,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
f AS (
  SELECT doc_id, lang, w, CAST(len(w) AS BIGINT) AS n, CAST(length(solid) AS BIGINT) AS chars, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS dup,
    [length(regexp_replace(solid, '[^A-ZÀ-ÖØ-Þ]+', '', 'g')), length(regexp_replace(solid, '[^0-9]+', '', 'g')), length(regexp_replace(solid, '[^.,]+', '', 'g')),
     length(regexp_replace(solid, '[^!?]+', '', 'g')), length(regexp_replace(solid, '[^#*$%&|<>]+', '', 'g')), length(regexp_replace(solid, '[^\x{80}-\x{BF}×ß-\x{10FFFF}]+', '', 'g'))] AS c FROM a),
k AS (SELECT *, list_append(c, chars - list_sum(c)) AS classes FROM f),
win AS (SELECT doc_id, i, w[i:i + 7] AS x FROM (SELECT doc_id, w, unnest(range(1, n - 6)) AS i FROM k WHERE n > 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS m FROM win) WHERE m > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
word AS (SELECT doc_id, lang, lower(unnest(w)) AS word FROM k),
wc AS (SELECT lang, word, count(*) AS m FROM word GROUP BY 1, 2),
total AS (SELECT lang, sum(m) AS total FROM wc GROUP BY 1),
known AS (SELECT lang, total FROM total WHERE lang IS NOT NULL),
vocab AS (SELECT word, sum(m) AS m FROM wc GROUP BY word), everyone AS (SELECT sum(m)::DOUBLE AS t FROM vocab),
pool AS (SELECT wc.lang AS ref, word, m FROM wc JOIN known USING (lang) UNION ALL SELECT NULL, word, sum(m) FROM wc GROUP BY word),
sizes AS (SELECT lang AS ref, total FROM known UNION ALL SELECT NULL, sum(total) FROM total),
top AS (SELECT ref, word, m FROM (SELECT *, row_number() OVER (PARTITION BY ref ORDER BY m DESC, word) AS r FROM pool) WHERE r <= 32),
share AS (
  SELECT ref, word, (m + w * (vm::DOUBLE / e)) / (total::DOUBLE + w) AS q FROM (
    SELECT t.ref, t.word, t.m, v.m AS vm, s.total, everyone.t AS e, CASE WHEN t.ref IS NULL THEN 0.0 ELSE 50.0 END::DOUBLE AS w
    FROM top t JOIN sizes s ON t.ref IS NOT DISTINCT FROM s.ref JOIN vocab v ON v.word = t.word, everyone)),
sums AS (SELECT lang, i, sum(classes[i])::DOUBLE AS v FROM k, range(1, 8) r(i) GROUP BY 1, 2),
pooled AS (SELECT i, CASE WHEN sum(v) OVER () > 0 THEN v / sum(v) OVER () ELSE 0 END AS q FROM (SELECT i, sum(v) AS v FROM sums GROUP BY 1)),
cls AS (
  SELECT lang AS ref, list((v + 500.0::DOUBLE * pooled.q) / (s + 500.0::DOUBLE) ORDER BY i) AS q FROM (SELECT *, sum(v) OVER (PARTITION BY lang) AS s FROM sums WHERE lang IS NOT NULL) JOIN pooled USING (i) GROUP BY 1
  UNION ALL SELECT NULL, list(q ORDER BY i) FROM pooled),
ref AS (SELECT doc_id, n, CASE WHEN lang IN (SELECT ref FROM share) THEN lang END AS ref FROM k),
hits AS (SELECT doc_id, word, count(*) AS h FROM word GROUP BY 1, 2),
cell AS (
  SELECT r.doc_id, coalesce(h.h, 0)::DOUBLE / r.n AS p, s.q FROM ref r JOIN share s ON r.ref IS NOT DISTINCT FROM s.ref LEFT JOIN hits h ON h.doc_id = r.doc_id AND h.word = s.word WHERE r.n >= 40),
rest AS (SELECT doc_id, p, q FROM cell UNION ALL SELECT doc_id, 1 - sum(p), greatest(0, 1 - sum(q)) FROM cell GROUP BY doc_id),
wd AS (SELECT doc_id, sqrt(least(greatest(sum(CASE WHEN p > 1e-15 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (greatest(p, 0) + q)) ELSE 0 END) / 2, 0), 1)) AS x FROM rest GROUP BY doc_id),
cd AS (
  SELECT doc_id, sqrt(least(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0), 1)) AS x
  FROM (SELECT k.doc_id, classes[i]::DOUBLE / chars AS p, cls.q[i] AS q FROM k JOIN ref USING (doc_id) JOIN cls ON cls.ref IS NOT DISTINCT FROM ref.ref, range(1, 8) r(i) WHERE chars >= 200) GROUP BY doc_id),
o AS (
  SELECT k.doc_id, k.n AS n_words, chars AS word_chars, CAST(c[5] AS BIGINT) AS n_symbols, dup AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
    k.n < 20 OR 100 * coalesce(n_repeat, 0) > 30 * k.n AS base_failed, coalesce(cd.x, 0) > 0.11 + 5 / sqrt(greatest(chars, 1)) OR coalesce(wd.x, 0) > 0.13 + 2.5 / sqrt(greatest(k.n, 1)) AS far
  FROM k LEFT JOIN rep USING (doc_id) LEFT JOIN wd USING (doc_id) LEFT JOIN cd USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT far AS kept FROM o
"""
