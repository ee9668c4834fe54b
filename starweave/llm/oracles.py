"""DuckDB SQL for the queries that SQL can express: plain joins and counts
over exact words and lines, with none of the operators' methods."""

from __future__ import annotations

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SOLID = r"'[^\x20\x09-\x0D]+'"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), {_SOLID}) AS ws
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                      WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(ws) - 2),
                             lambda i: array_to_string(ws[i:i + 3], ' '))) END AS ss
  FROM w
), e AS (SELECT doc_id, len(ss) AS n, unnest(ss) AS s FROM s),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common, any_value(a.n + b.n) AS sizes
  FROM e AS a JOIN e AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM met WHERE 100 * common >= 80 * (sizes - common)
), edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id AS d, doc_id AS r FROM documents
  UNION
  SELECT edge.a AS d, reach.r FROM reach JOIN edge ON edge.b = reach.d
)
SELECT s.doc_id, len(ss) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT d, min(r) AS component_id FROM reach GROUP BY d) AS c ON c.d = s.doc_id
"""

_STOP = ("the of and to in a is that it for on was with be as this by are at from an "
         "de la le les des et un une en que du pour par dans est qui sur "
         "der die das und den von zu mit ist im ein eine sich nicht für auf "
         "el los las y se del con para por su una es al lo").split()
_STOP_LIST = ", ".join(f"'{f}'" for f in sorted({f for w in _STOP for f in (w, w.capitalize())}))


def _chars(chars: str) -> str:
    return " + ".join(f"(strlen(t) - strlen(replace(t, '{c}', '')))" for c in chars)


QUALITY = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_SOLID}) AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: trim(x, {_SPACE}) <> '') AS ls
  FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3
), r AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS k FROM g
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r WHERE k > 1) GROUP BY doc_id
), c AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST({_chars('#*$%&|<>')} AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         len(ls) AS n_lines,
         len(list_filter(ws, lambda x: x IN ({_STOP_LIST}))) AS n_stop,
         {_chars('ABCDEFGHIJKLMNOPQRSTUVWXYZ')} AS n_upper
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id
), v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 12 * n_words
       AND n_symbols <= n_words * CAST(0.1 AS DOUBLE) AND n_upper <= word_chars * CAST(0.4 AS DOUBLE)
       AND n_stop >= n_words * CAST(0.02 AS DOUBLE)
       AND n_dup_lines <= n_lines * CAST(0.5 AS DOUBLE) AS kept
FROM v
"""

PREFERENCES = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), answer AS (
  SELECT conv_id, max(i) AS k, arg_max(text, i) AS text FROM t WHERE role = 'assistant'
  GROUP BY conv_id
), opening AS (
  SELECT conv_id, md5(role || '|' || text) AS h FROM t WHERE i = 1
), p AS (
  SELECT o.c, o.r, o.same OR ca.k IS NULL OR ra.k IS NULL AS whole, ca.k, ra.text AS answer
  FROM (SELECT conv_id AS c, lead(conv_id) OVER w AS r, h = lead(h) OVER w AS same
        FROM opening WINDOW w AS (ORDER BY h, conv_id)) AS o
  LEFT JOIN answer AS ca ON ca.conv_id = o.c LEFT JOIN answer AS ra ON ra.conv_id = o.r
  WHERE o.r IS NOT NULL
), turns AS (
  SELECT p.c, p.r, 0 AS side, t.i, t.role, t.text FROM p JOIN t ON t.conv_id = p.c
  UNION ALL
  SELECT p.c, p.r, 1, t.i, t.role, t.text FROM p JOIN t ON t.conv_id = p.r WHERE whole
  UNION ALL
  SELECT p.c, p.r, 1, t.i, t.role, CASE WHEN t.i = p.k THEN p.answer ELSE t.text END
  FROM p JOIN t ON t.conv_id = p.c WHERE NOT whole
), met AS (
  SELECT c, r, i, count(*) = 2 AND count(DISTINCT (role, text)) = 1 AS same
  FROM turns GROUP BY c, r, i
), common AS (
  SELECT c, r, coalesce(min(i) FILTER (WHERE NOT same) - 1, max(i)) AS n FROM met GROUP BY c, r
), shown AS (
  SELECT turns.*, common.n, '<|' || role || '|>' || chr(10) || text || chr(10) AS s
  FROM turns JOIN common USING (c, r)
), placed AS (
  SELECT *, coalesce(sum(length(s)) OVER (PARTITION BY c, r, side, i <= n ORDER BY i
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM shown
)
SELECT c AS chosen_id, r AS rejected_id, CAST(any_value(n) AS BIGINT) AS n_common,
       coalesce(string_agg(s, '' ORDER BY i) FILTER (WHERE side = 0 AND i <= n), '') AS prompt,
       coalesce(string_agg(s, '' ORDER BY i) FILTER (WHERE side = 0 AND i > n), '') AS chosen,
       coalesce(string_agg(s, '' ORDER BY i) FILTER (WHERE side = 1 AND i > n), '') AS rejected,
       coalesce(string_agg(pos || ':' || length(s) || ':' || (role = 'assistant'), ',' ORDER BY i)
                FILTER (WHERE side = 0 AND i > n), '') AS chosen_mask,
       coalesce(string_agg(pos || ':' || length(s) || ':' || (role = 'assistant'), ',' ORDER BY i)
                FILTER (WHERE side = 1 AND i > n), '') AS rejected_mask
FROM placed GROUP BY c, r
"""

LINE_DEDUP = f"""
WITH l AS (
  SELECT doc_id, i, line, translate(trim(line, {_SPACE}), {_AZ}) AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents)
), k AS (
  SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT l.*, k.key IS NOT NULL AND l.doc_id <> k.last AS gone FROM l LEFT JOIN k USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), ''))
       AS kept_sha256
FROM m GROUP BY doc_id
"""

DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), {_AZ}),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), g AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n,
         unnest(list_transform(range(1, greatest(len(ws) - 9, 1) + 1),
                lambda i: array_to_string(ws[i:i + least(10, len(ws)) - 1], ' '))) AS gram
  FROM b WHERE len(ws) > 0
), sizes AS (SELECT DISTINCT n FROM g),
places AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS gram
  FROM (SELECT d.doc_id, d.ws, sizes.n, unnest(range(1, len(ws) - sizes.n + 2)) AS i
        FROM d, sizes WHERE len(d.ws) >= sizes.n)
), hits AS (SELECT p.doc_id, p.i, p.n, g.item_id FROM places AS p JOIN g USING (n, gram)),
words AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(words.n_hit, 0) AS n_hit,
       coalesce(items.n_items, 0) AS n_items, sha256(coalesce(items.names, '')) AS items_sha256,
       coalesce(words.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

URL_FILTER = f"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), p AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM u
), rules(host, path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
  SELECT p.page_id, p.host, p.path,
         arg_max(rules.host || rules.path, length(rules.host || rules.path)) AS rule,
         arg_max(rules.verdict, length(rules.host || rules.path)) AS verdict
  FROM p LEFT JOIN rules
    ON (p.host = rules.host OR ends_with(p.host, '.' || rules.host))
   AND starts_with(p.path, rules.path)
  GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best
"""

COLLOCATIONS = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), {_AZ}),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), totals AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang
), sized AS (SELECT lang, ws, unnest(range(1, 6)) AS m FROM w),
g AS (
  SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2),
                                        lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
  FROM sized WHERE len(ws) >= m
), f AS (
  SELECT lang, m, phrase, count(*) AS c FROM g GROUP BY ALL HAVING count(*) >= 100
), parts AS (
  SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE m > 1
), cuts AS (
  SELECT *, unnest(range(1, m)) AS k FROM parts
), scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.c AS a, l.c AS l, r.c AS r, n, k,
         (CAST(1000 AS HUGEINT) * cuts.c * n) // (CAST(l.c AS HUGEINT) * r.c) AS score
  FROM cuts JOIN totals USING (lang)
  JOIN f AS l ON l.lang = cuts.lang AND l.phrase = array_to_string(ws[1:k], ' ')
  JOIN f AS r ON r.lang = cuts.lang AND r.phrase = array_to_string(ws[k + 1:], ' ')
), weakest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT DISTINCT s.lang, s.phrase FROM parts AS s JOIN parts AS t
    ON s.lang = t.lang AND t.m > s.m AND t.c >= s.c
   AND contains(' ' || t.phrase || ' ', ' ' || s.phrase || ' ')
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, n, CAST(score AS BIGINT) AS score
  FROM weakest ANTI JOIN inside USING (lang, phrase)
)
SELECT * FROM ranked WHERE rank <= 2000
"""

# CRC-32 (reflected polynomial 3988292384) over UTF-8 bytes; near words share a
# pattern with one place left open, or one is the other without a code point.
SPELLING = rf"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''),
           '[A-Za-z\x{{C0}}-\x{{FF}}]+')), {_AZ}) AS run
  FROM documents
), d AS (
  SELECT doc_id, run, count(*) AS c FROM runs GROUP BY ALL
), named AS (
  SELECT run, c, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
           lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
                          ELSE [CAST(192 + unicode(x) // 64 AS BIGINT),
                                CAST(128 + unicode(x) % 64 AS BIGINT)] END)) AS bytes
  FROM d
), hashed AS (
  SELECT run, c, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
           lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1]))) AS h
  FROM named, tab
), cut AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, c
  FROM hashed
), v AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM cut
  GROUP BY word HAVING length(word) >= 5 AND sum(c) >= 3
), places AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v
), holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hole,
         substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM places
), near AS (
  SELECT a.word, b.word AS other, b.n FROM holes AS a JOIN holes AS b
    ON a.hole = b.hole AND a.word <> b.word
  UNION
  SELECT a.word, v.word, v.n FROM holes AS a JOIN v ON a.less = v.word
  UNION
  SELECT v.word, a.word, a.n FROM holes AS a JOIN v ON a.less = v.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS top FROM near GROUP BY word
), formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN top >= 2 * v.n THEN (SELECT min(other) FROM near
           WHERE near.word = v.word AND near.n = top) END AS form,
         CASE WHEN top >= 2 * v.n THEN top END AS form_n
  FROM v LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at FROM formed
  UNION
  SELECT walk.word, formed.form FROM walk JOIN formed ON formed.word = walk.at
  WHERE formed.form IS NOT NULL
)
SELECT formed.word, formed.n, formed.n_near, formed.form, formed.form_n, walk.at AS root
FROM formed JOIN walk USING (word) JOIN formed AS last ON last.word = walk.at
WHERE last.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_near_duplicates": NEAR_DUPLICATES,
        "op4_quality_rules": QUALITY,
        "op5_preference_format": PREFERENCES,
        "op6_line_dedup": LINE_DEDUP,
        "op9_decontamination": DECONTAMINATION,
        "op10_url_filter": URL_FILTER,
        "op11_collocations": COLLOCATIONS,
        "op13_spelling_variants": SPELLING,
    }
