"""DuckDB SQL of the queries whose whole result SQL can express."""

_DEAL = """SELECT *, CAST(least(cap, floor(w * max(lv) OVER (PARTITION BY {up}))) AS BIGINT) AS alloc FROM (
  SELECT *, (given - coalesce(sum(cap) OVER (PARTITION BY {up} ORDER BY cap / w, {node}
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (PARTITION BY {up} ORDER BY cap / w, {node}
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM ({src}))"""

OP8_SQL = f"""
WITH d AS (
  SELECT doc_id, lang, source,
         CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '' THEN 'other'
              ELSE ['web', 'reference', 'forum'][CAST(CAST(regexp_extract(source, '([0-9]+)$', 1) AS HUGEINT) % 3 + 1 AS BIGINT)]
         END AS domain,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n_tokens
  FROM documents),
leaf AS (
  SELECT domain AS a, coalesce(lang, '') AS b, coalesce(source, '') AS c,
         CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) * 4 AS BIGINT) AS cap
  FROM d GROUP BY ALL),
n1 AS ({_DEAL.format(up='root', node='a', src='''
  SELECT 0 AS root, a, CAST(sum(cap) AS BIGINT) AS cap,
         CASE a WHEN 'web' THEN 5 WHEN 'reference' THEN 3 WHEN 'forum' THEN 2 ELSE 1 END AS w,
         (SELECT CAST(sum(tokens) AS BIGINT) FROM leaf) AS given
  FROM leaf GROUP BY a''')}),
n2 AS ({_DEAL.format(up='a', node='b', src='''
  SELECT l.a, b, CAST(sum(l.cap) AS BIGINT) AS cap,
         CASE b WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END AS w,
         any_value(n1.alloc) AS given
  FROM leaf l JOIN n1 ON l.a = n1.a GROUP BY l.a, b''')}),
n3 AS ({_DEAL.format(up='a, b', node='c', src='''
  SELECT l.a, l.b, l.c, l.cap, l.tokens, 1 AS w, n2.alloc AS given
  FROM leaf l JOIN n2 ON l.a = n2.a AND l.b = n2.b''')}),
t AS (
  SELECT d.*, alloc AS leaf_budget, coalesce(alloc // nullif(tokens, 0), 0) AS whole,
         coalesce(alloc % nullif(tokens, 0), 0) AS rest,
         md5('7:' || coalesce(alloc // nullif(tokens, 0), 0) || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM d JOIN n3 ON domain = a AND coalesce(lang, '') = b AND coalesce(source, '') = c)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens, leaf_budget,
       CAST(whole + CASE WHEN rest > 0 AND sum(n_tokens) OVER (
         PARTITION BY domain, coalesce(lang, ''), coalesce(source, '') ORDER BY k, n_tokens
         ROWS UNBOUNDED PRECEDING) <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM t"""

OP2_SQL = """
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents),
win AS (
  SELECT doc_id, p, md5(array_to_string(words[p:p + 49], ' ')) AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM d)),
hit AS (
  SELECT DISTINCT doc_id, p FROM win JOIN (SELECT k, min(doc_id) AS lo FROM win GROUP BY k) USING (k)
  WHERE lo < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM hit),
word AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

OP5_SQL = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10"""


OP12_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, array_to_string(ws[s:s + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS s
        FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
t AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
inside AS (
  SELECT lang, array_to_string(ws[s:s + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT lang, ws, a, m, unnest(range(1, k - m + 2)) AS s
        FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN inside USING (lang, phrase) WHERE coalesce(100 * most, 0) < 100 * a),
cut AS (
  SELECT kept.lang, kept.phrase, a, j, x.f AS l, y.f AS r, n,
         CAST(1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept) kept
  JOIN f x ON x.lang = kept.lang AND x.phrase = array_to_string(ws[1:j], ' ')
  JOIN f y ON y.lang = kept.lang AND y.phrase = array_to_string(ws[j + 1:kept.k], ' ')
  JOIN t ON t.lang = kept.lang),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank,
       phrase, a, l, r, n, score
FROM low QUALIFY rank <= 2000"""
