"""DuckDB SQL of the operators that SQL can express, in formulations of their own."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(column: str) -> str:
    return f"translate({column}, '{_UPPER}', '{_LOWER}')"


def alnum_words(column: str) -> str:
    """Runs of ASCII letters and digits and of anything beyond ASCII."""
    return rf"regexp_extract_all({ascii_lower(column)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


DECONTAMINATE = f"""
WITH item AS (SELECT item_id, {alnum_words('text')} AS w FROM benchmark),
place AS (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, array_to_string(w[i:i+12], ' ') AS win, least(len(w), 13) AS n FROM place),
doc AS (SELECT doc_id, coalesce({alnum_words('text')}, []) AS w FROM documents),
size AS (SELECT DISTINCT n FROM win),
spot AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, size WHERE len(w) >= n),
hit AS (SELECT spot.doc_id, spot.i, spot.n, win.item_id FROM
        (SELECT doc_id, n, i, array_to_string(w[i:i+n-1], ' ') AS win FROM spot) spot
        JOIN win ON win.win = spot.win AND win.n = spot.n),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
         (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
names AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
          FROM hit GROUP BY doc_id)
"""

DECONTAMINATE += """
SELECT doc.doc_id, len(doc.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(doc.w) AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN names USING (doc_id)
"""


MIXING = """
WITH sizes AS (SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS size FROM documents GROUP BY source),
w AS (SELECT source, size, CASE WHEN size > 0 THEN pow(size, 0.7) ELSE 0 END AS w FROM sizes),
rates AS (SELECT source, CASE WHEN size > 0 THEN 1.0 * w / sum(w) OVER () * sum(size) OVER () / size ELSE 1.0 END AS rate FROM w),
terms AS (SELECT source, rate, unnest(generate_series(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT)) AS k FROM rates),
cum AS (SELECT source, rate, sum(CASE WHEN rate > 0 THEN exp(k * ln(rate) - rate - lgamma(k + 1)) ELSE (k = 0)::INT END)
               OVER (PARTITION BY source ORDER BY k) AS below FROM terms),
cdf AS (SELECT source, rate, list(below) AS cdf FROM cum GROUP BY source, rate),
drawn AS (SELECT d.doc_id, d.source, d.text, rate,
                 len(list_filter(cdf, lambda c: c <= ('0x' || substr(md5('5:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT
                                                     / 4503599627370496.0)) AS copies
          FROM documents d JOIN cdf ON cdf.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, source, text, round(rate, 6) AS rate, copies::INT AS copies, copy::INT AS copy,
       md5('deal5:' || coalesce(doc_id::VARCHAR, '') || ':' || copy) AS shuffle_key
FROM (SELECT *, unnest(generate_series(1, copies)) AS copy FROM drawn WHERE copies > 0)
"""

_SPACE_WORDS = r"[^\x20\x09-\x0D]+"

LINE_RULES = rf"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, '{_SPACE_WORDS}'), []) AS w FROM documents),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS t
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM doc)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
ln AS (SELECT doc_id, line, pos, regexp_extract_all(line, '{_SPACE_WORDS}') AS lw,
              row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) > 1 AS dup
       FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM doc)
       WHERE len(regexp_extract_all(line, '{_SPACE_WORDS}')) > 0),
stat AS (SELECT *, len(lw) AS n, len(list_filter(lw, lambda x: x = '|' OR x = '>')) AS seps,
                len(list_filter(lw, lambda x: regexp_matches(x, '[#*$%&|<>]'))) AS sym,
                len(list_filter(lw, lambda x: regexp_matches(x, '[A-Z].*[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS shout FROM ln),
bad AS (SELECT doc_id, dup, n,
               (seps >= 2 AND 5 * seps >= n) OR 4 * sym > n OR (n >= 3 AND 2 * shout > n)
               OR (n < 5 AND NOT regexp_matches(lw[-1], '[.!?:;"'')]$')) OR dup
               OR regexp_matches(line, '(?i)all rights reserved|cookie policy|privacy policy|terms of use|terms of service|log in|sign up|subscribe to|javascript|skip to content')
               AS failed FROM stat),
lines AS (SELECT doc_id, sum(dup::INT) AS n_dup_lines, sum(CASE WHEN failed THEN n ELSE 0 END) AS lost FROM bad GROUP BY doc_id),
base AS (SELECT doc.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                coalesce(lost, 0)::BIGINT AS n_lost_words
         FROM doc LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * n_lost_words <= n_words AS kept FROM base
"""

_BLOCK = r"(?i)</?(p|div|li|ul|ol|h[1-6]|br|nav|footer|header|article|section|aside|table|tr|title|body|head|html)\b[^>]*>"

SITE_LINES = rf"""
WITH page AS (SELECT page_id, url, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '') AS host,
    list_filter(list_transform(string_split(regexp_replace(regexp_replace(
        regexp_replace(coalesce(html, ''), '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', chr(10), 'g'),
        '{_BLOCK}', chr(10), 'g'), '<[^>]*>', '', 'g'), chr(10)),
        lambda x: trim(regexp_replace(x, '[ \t\r\f\x0B]+', ' ', 'g'))), lambda x: x <> '') AS lines FROM pages),
total AS (SELECT host, count(*) AS pages FROM page WHERE host IS NOT NULL GROUP BY host),
often AS (SELECT host, line FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM page WHERE host IS NOT NULL)
          JOIN total USING (host) GROUP BY host, line, pages HAVING count(*) >= 2 AND count(*) > 0.1 * pages),
boiler AS (SELECT host, list(line) AS b FROM often GROUP BY host),
kept AS (SELECT page_id, url, page.host, lines, CASE WHEN b IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(b, x)) END AS k
         FROM page LEFT JOIN boiler ON page.host = boiler.host)
SELECT page_id, url, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(k))::BIGINT AS n_dropped,
       coalesce(array_to_string(k, chr(10)), '') AS text FROM kept
"""

#: The 256 remainders of the crc32 polynomial, and the crc32 of a blob by them.
_CRC_TABLE = "SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda a, k: " \
             "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n)) AS t"


def crc32(text: str) -> str:
    byte = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), (2 * i + 1)::INT, 2))::BIGINT)"
    return f"xor(list_reduce({byte}, lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8), 4294967295), 4294967295)"


SPELLING = rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
run AS (SELECT doc_id, {ascii_lower('r')} AS w, count(*) AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS r FROM documents) GROUP BY ALL),
marked AS (SELECT w, n, {crc32("doc_id::VARCHAR || ':' || w")} AS h FROM run, crc),
vocab AS (SELECT word, sum(n)::BIGINT AS n
          FROM (SELECT CASE WHEN h % 97 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM marked)
          WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
spot AS (SELECT word, n, unnest(range(length(word))) AS i FROM vocab),
part AS (SELECT word, n, i, left(word, i) AS a, substr(word, i + 2) AS z FROM spot),
near AS (SELECT DISTINCT x.word, x.n, y.word AS other, y.n AS other_n FROM part x JOIN part y USING (i, a, z) WHERE x.word <> y.word
         UNION SELECT x.word, x.n, y.word, y.n FROM part x JOIN vocab y ON y.word = x.a || x.z
         UNION SELECT y.word, y.n, x.word, x.n FROM part x JOIN vocab y ON y.word = x.a || x.z),
best AS (SELECT word, count(*) AS n_near, arg_max(other, (other_n, -r)) AS form, max(other_n) AS form_n
         FROM (SELECT *, row_number() OVER (ORDER BY other) AS r FROM near) GROUP BY word),
named AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * v.n THEN form END AS form,
                 CASE WHEN form_n >= 2 * v.n THEN form_n END AS form_n FROM vocab v LEFT JOIN best USING (word)),
step AS (SELECT word, form, word AS root FROM named
         UNION ALL SELECT step.word, named.form, named.word FROM step JOIN named ON named.word = step.form)
SELECT named.word, named.form, step.root, n, n_near, form_n
FROM named JOIN step ON step.word = named.word AND step.form IS NULL
"""

PERIODIC = rf"""
WITH crc AS ({_CRC_TABLE}),
doc AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{_SPACE_WORDS}'), []) AS w, {crc32('doc_id::VARCHAR')} AS h FROM documents, crc),
cut AS (SELECT doc_id, w, len(w) AS n, h, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN h // 10 % len(w) END AS a FROM doc),
tail AS (SELECT doc_id, w, n, a, 1 + (n - a) // (3 + g % 8) AS p FROM cut),
place AS (SELECT doc_id, w, n, a, p, unnest(range(n)) AS i FROM tail),
word AS (SELECT doc_id, n, i, w[1 + CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % p END] AS word FROM place),
pair AS (SELECT x.doc_id, x.i, x.i - y.i AS q FROM word x JOIN word y
         ON x.doc_id = y.doc_id AND x.word = y.word AND y.i < x.i AND 3 * (x.i - y.i) <= x.n),
same AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pair),
stretch AS (SELECT doc_id, q, min(i) - q AS start, count(*) + q AS length FROM same GROUP BY doc_id, q, island),
run AS (SELECT doc_id, start, length, min(q) AS period FROM stretch WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length),
best AS (SELECT * FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) = 1),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
           FROM run GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM word
         WHERE NOT EXISTS (SELECT 1 FROM run WHERE run.doc_id = word.doc_id AND word.i >= run.start + run.period AND word.i < run.start + run.length)
         GROUP BY doc_id)
SELECT doc.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.period::BIGINT AS period,
       (1000 * best.length // best.period)::BIGINT AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM doc LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

JACCARD = rf"""
WITH RECURSIVE doc AS (SELECT doc_id, coalesce(regexp_extract_all({ascii_lower('text')}, '{_SPACE_WORDS}'), []) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(len(w) - 4), lambda i: array_to_string(w[i+1:i+5], ' ')) END) AS s FROM doc)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
inter AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM inter JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
way AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT x AS doc_id, y AS r FROM way UNION SELECT reach.doc_id, way.y FROM reach JOIN way ON way.x = reach.r),
low AS (SELECT doc_id, min(r) AS r FROM reach GROUP BY doc_id),
degree AS (SELECT x AS doc_id, count(*) AS k FROM way GROUP BY x)
SELECT doc.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc.doc_id, coalesce(r, doc.doc_id)) AS component_id,
  coalesce(k, 0)::BIGINT AS n_links
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN low USING (doc_id) LEFT JOIN degree USING (doc_id)
"""
