"""SQL counterparts of the queries that SQL can express."""

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

OP3 = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), d AS (
  SELECT page_id, payload, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS hex,
    min(page_id) OVER (PARTITION BY payload) AS first_id
  FROM p
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INT)) & 31 AS INT),
    1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""

OP5 = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents
), lines AS (
  SELECT doc_id, l FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM t)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), line_counts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM lines GROUP BY doc_id
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM t WHERE len(w) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n >= 2
), repeats AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM twice, (SELECT unnest(range(0, 8)) AS j) GROUP BY doc_id
), m AS (
  SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines,
    CAST(coalesce(len(list_filter(generate_series(2, len(w)), lambda i: w[i] = w[i - 1])), 0) AS BIGINT) AS n_adjacent,
    CAST(length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS BIGINT) AS n_upper,
    CAST(length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) AS BIGINT) AS n_lower,
    CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS n_exclaim
  FROM t LEFT JOIN line_counts USING (doc_id) LEFT JOIN repeats USING (doc_id)
), r AS (
  SELECT *,
    CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 12 * n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_adjacent > 20 * n_words THEN 8 ELSE 0 END
    + CASE WHEN 100 * n_upper > 50 * (n_upper + n_lower) THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_exclaim > 30 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 64 ELSE 0 END
    + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words) THEN 128 ELSE 0 END AS f
  FROM m
)
SELECT doc_id, CAST(f AS BIGINT) AS failed, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
  n_adjacent, n_upper, n_lower, n_exclaim, f & 3 <> 0 AS base_failed, f = 0 AS kept
FROM r
"""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP9 = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, {WORDS.format(text=LOWERED)} AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, least(len(w), 1)))) AS i FROM t)
), n AS (
  SELECT doc_id, count(*) AS n_shingles FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM s AS a JOIN s AS b USING (shingle)
  WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM common JOIN n AS p ON p.doc_id = x JOIN n AS q ON q.doc_id = y
  WHERE 100 * n_both >= 75 * (p.n_shingles + q.n_shingles - n_both)
), ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id, doc_id AS found FROM documents
  UNION
  SELECT doc_id, y FROM reach JOIN ways ON found = x
)
SELECT d.doc_id, coalesce(n_shingles, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents AS d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(found) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

TERMS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"

OP13 = rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {TERMS} AS w FROM documents
), groups AS (
  SELECT DISTINCT lang, source FROM t
), words AS (
  SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM t) GROUP BY ALL
), kept AS (
  SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM words GROUP BY lang, term HAVING count(*) >= 30
), own AS (
  SELECT w.lang, w.source, w.term, CAST(sum(w.n) AS BIGINT) AS n
  FROM words AS w JOIN kept AS k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL
), sizes AS (
  SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS n FROM kept GROUP BY lang
), totals AS (
  SELECT g.lang, g.source, v, z.n AS lang_n, CAST(coalesce(sum(o.n), 0) AS BIGINT) AS n
  FROM groups AS g JOIN sizes AS z USING (lang) LEFT JOIN own AS o ON o.lang = g.lang AND o.source = g.source GROUP BY ALL
), shares AS (
  SELECT a.lang, a.source, k.term, coalesce(o.n, 0) AS n,
    1 + 1000000000 * (coalesce(o.n, 0) + 5) // (a.n + 5 * a.v) AS p, 1 + 1000000000 * (k.n + 5) // (a.lang_n + 5 * a.v) AS q
  FROM totals AS a JOIN kept AS k ON k.lang = a.lang
  LEFT JOIN own AS o ON o.lang = a.lang AND o.source = a.source AND o.term = k.term
), pairs AS (
  SELECT x.lang, x.source, y.source AS item, CAST(sum(abs(x.p - y.p)) AS BIGINT) AS value
  FROM shares AS x JOIN shares AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
), every AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(p.value, 0) AS value
  FROM groups AS x JOIN groups AS y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN pairs AS p ON p.lang = x.lang AND p.source = x.source AND p.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked
WHERE part = 'pair' OR rank <= 50
"""

ORACLES: dict[str, str] = {"op3_warc_salvage": OP3, "op5_rule_ledger": OP5, "op9_odd_sketches": OP9, "op13_divergence_audit": OP13}
