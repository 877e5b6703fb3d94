"""The SQL of the operators that SQL can express, for DuckDB."""

_STOP_WORDS = """
the and of to in is that it was for on are with this be at by from not a as
der die das und ist von den des dem ein eine zu mit nicht auf für
le la les de du et est un une que qui dans en des pour pas au
el los las y es una por con no se para su
""".split()

QUALITY_SQL = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS g
  FROM w, unnest(generate_series(1, len(words) - 4)) AS u(i)),
twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         len(list_filter(words, lambda x: lower(x) IN ({', '.join(f"'{x}'" for x in _STOP_WORDS)})))::BIGINT
           AS n_stop_words
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND n_words BETWEEN 10 AND 200000
       AND word_chars::DOUBLE / greatest(n_words, 1) BETWEEN 2 AND 15
       AND n_symbols::DOUBLE / greatest(n_words, 1) <= 0.25
       AND n_stop_words::DOUBLE / greatest(n_words, 1) >= 0.01
       AND n_dup_lines::DOUBLE / greatest(n_lines, 1) <= 0.3
       AND n_repeat_words::DOUBLE / greatest(n_words, 1) <= 0.2 AS kept
FROM b
"""

_HOST = r"'^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1"

URL_SQL = rf"""
WITH captures AS (
  SELECT page_id, url, DATE '2023-01-01' + (('0x' || substr(md5(page_id::VARCHAR), 1, 7))::INT % 730) AS fetched_at,
         rtrim(lower(regexp_extract(url, {_HOST})), '.') AS host,
         regexp_extract(url, '^[a-z]+://[^/?#]*/([^/?#]+)', 1) AS first
  FROM pages),
hosts AS (SELECT host, ('0x' || substr(md5(host), 1, 7))::INT AS h FROM captures WHERE host <> '' GROUP BY host),
days AS (SELECT host, h, h // 4 % 500 AS b, h // 4 % 500 + 30 + h // 97 % 150 AS e FROM hosts WHERE h % 4 = 0),
blocked AS (
  SELECT host AS entry, h, b AS low, CASE WHEN h % 8 = 0 THEN e ELSE 100000 END AS high FROM days
  UNION ALL SELECT host, h, e + 60, 100000 FROM days WHERE h % 16 = 0),
allowed AS (
  SELECT entry, ('0x' || substr(md5(entry), 1, 7))::INT AS h
  FROM (SELECT DISTINCT host || '/' || first AS entry FROM captures WHERE host <> '' AND first <> '')),
rules AS (
  SELECT 'domain' AS kind, entry, 'block' AS action, 'c' || (h % 3) AS category, low, high FROM blocked
  UNION ALL SELECT 'prefix', entry, 'allow', 'reviewed', h // 5 % 730, 100000 FROM allowed WHERE h % 5 = 0),
found AS (
  SELECT c.page_id, r.*,
         row_number() OVER (PARTITION BY c.page_id ORDER BY length(entry) DESC, action, kind, entry, category) AS n
  FROM captures c JOIN rules r
    ON (r.kind = 'domain' AND (c.host = r.entry OR ends_with(c.host, '.' || r.entry))
        OR r.kind = 'prefix' AND c.host || '/' || c.first = r.entry)
   AND c.fetched_at - DATE '2023-01-01' >= r.low AND c.fetched_at - DATE '2023-01-01' < r.high)
SELECT c.page_id, c.url, c.fetched_at::DATE::VARCHAR AS fetched_at, coalesce(f.action = 'block', false) AS blocked, f.entry AS rule,
       f.kind AS rule_kind, f.category
FROM captures c LEFT JOIN found f ON f.page_id = c.page_id AND f.n = 1
"""

FILL_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id::VARCHAR) AS h FROM documents),
u AS (
  SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines, ('0x' || substr(h, 1, 8))::BIGINT AS h1,
         ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM d),
c AS (
  SELECT *, len(lines)::BIGINT AS n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u),
p AS (
  SELECT *, array_to_string(lines[1:a], '') AS pre, array_to_string(lines[a + 1:b], '') AS mid,
         array_to_string(lines[b + 1:], '') AS suf
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(pre || mid || suf) AS restored_sha256
FROM p
"""

COLLOCATION_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (
  SELECT lang, id, unnest(words) AS word, generate_subscripts(words, 1) AS pos
  FROM (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces)),
g AS (
  SELECT lang, word AS w1, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3, lead(word, 3) OVER p AS w4
  FROM w WINDOW p AS (PARTITION BY id ORDER BY pos)),
f AS (
  SELECT lang, w1 AS phrase, [w1] AS words, 1 AS m, count(*) AS a FROM g GROUP BY lang, w1
  UNION ALL SELECT lang, concat_ws(' ', w1, w2), [w1, w2], 2, count(*) FROM g WHERE w2 IS NOT NULL
  GROUP BY lang, w1, w2 HAVING count(*) >= 30
  UNION ALL SELECT lang, concat_ws(' ', w1, w2, w3), [w1, w2, w3], 3, count(*) FROM g WHERE w3 IS NOT NULL
  GROUP BY lang, w1, w2, w3 HAVING count(*) >= 30
  UNION ALL SELECT lang, concat_ws(' ', w1, w2, w3, w4), [w1, w2, w3, w4], 4, count(*) FROM g WHERE w4 IS NOT NULL
  GROUP BY lang, w1, w2, w3, w4 HAVING count(*) >= 30),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
cuts AS (
  SELECT p.lang, p.phrase, p.a, k, x.a AS l, y.a AS r, (2000000::HUGEINT * p.a // (x.a + y.a))::BIGINT AS score
  FROM f p, range(1, 4) AS c(k), f x, f y
  WHERE p.m > 1 AND k < p.m AND p.a >= 30
    AND x.lang = p.lang AND x.phrase = array_to_string(p.words[1:k], ' ')
    AND y.lang = p.lang AND y.phrase = array_to_string(p.words[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(words[i:i + k - 1], ' ') AS phrase, max(a) AS longer
  FROM f, range(2, 4) AS s(k), unnest(generate_series(1, m - k + 1)) AS u(i)
  WHERE m > k GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, encode(b.phrase))::BIGINT AS rank,
       b.phrase, b.a, l, r, n, score
FROM best b JOIN totals t ON t.lang = b.lang LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase
WHERE longer IS NULL OR 100 * longer < 80 * b.a
QUALIFY rank <= 2000
"""
