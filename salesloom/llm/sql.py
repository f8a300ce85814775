"""The registered queries of this package again, as SQL for another engine."""

from __future__ import annotations

from salesloom.llm import license_scan

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

URL_FILTER = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut
), rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), fitting AS (
  SELECT p.page_id, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, r.verdict DESC) AS place
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fitting f ON p.page_id = f.page_id AND f.place = 1
"""

QUALITY_RULES = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents
), w AS (
  SELECT doc_id, text, host, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), grams AS (
  SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)
), again AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM again, range(0, 5) AS r(j) GROUP BY doc_id
), lines AS (
  SELECT doc_id, host, text, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line,
    len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, host, text, unnest(ls) AS l FROM w)
), texts AS (
  SELECT host, count(DISTINCT text) AS n FROM d GROUP BY host
), often AS (
  SELECT l.host, l.line FROM (SELECT host, line, count(DISTINCT text) AS n FROM lines GROUP BY ALL) l
  JOIN texts t ON l.host = t.host WHERE l.n >= 5 AND l.n > 0.03 * t.n
), spared AS (
  SELECT w.doc_id FROM w JOIN (SELECT doc_id, sum(n) AS n FROM lines SEMI JOIN often USING (host, line) GROUP BY doc_id) x USING (doc_id)
  WHERE len(ws) - x.n >= 10 AND 100 * (len(ws) - x.n) >= 30 * len(ws)
), boilerplate AS (
  SELECT l.host, l.line FROM (
    SELECT host, line, count(DISTINCT text) AS n FROM lines SEMI JOIN spared USING (doc_id) SEMI JOIN often USING (host, line) GROUP BY ALL) l
  JOIN texts t ON l.host = t.host WHERE l.n >= 5 AND l.n > 0.03 * t.n
), removed AS (
  SELECT doc_id, sum(n) AS n FROM lines SEMI JOIN boilerplate USING (host, line) GROUP BY doc_id
), figures AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(x.n, 0) AS BIGINT) AS removed_words
  FROM w LEFT JOIN repeats r USING (doc_id) LEFT JOIN removed x USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM figures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - removed_words >= 10 AND 100 * (n_words - removed_words) >= 30 * n_words AS kept, removed_words
FROM judged
"""


def _spaced(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _letters(text: str) -> str:
    low = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    return rf"list_filter(regexp_split_to_array({low}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


def _license_scan(gap: int = 8, coverage: float = 0.7) -> str:
    values = ", ".join(f"('{a}', {b}, {c}, {d}, {e}, '{f}')" for a, b, c, d, e, f in license_scan.template_rows())
    return f"""
WITH t(label, exact, words, votes, t_place, t_pair) AS (VALUES {values}),
w AS (SELECT doc_id, {_letters('text')} AS ws FROM documents),
pairs AS (SELECT doc_id, i - 1 AS place, ws[i] || ' ' || ws[i + 1] AS pair FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM w)),
diagonals AS (
  SELECT doc_id, label, exact, words, votes, place - t_place AS diagonal, list(DISTINCT t_place) AS matched, min(place) AS low, max(place) AS high
  FROM pairs JOIN t ON pair = t_pair GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN exact OR coalesce(diagonal - lag(diagonal) OVER along > {gap}, TRUE) THEN 1 ELSE 0 END AS opens FROM diagonals
  WINDOW along AS (PARTITION BY doc_id, label, exact, words, votes ORDER BY diagonal)),
numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY doc_id, label, exact, words, votes ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS span FROM marked),
spans AS (
  SELECT doc_id, label, exact, words, votes, len(list_distinct(flatten(list(matched)))) AS found, min(low) AS start, max(high) + 2 AS stop
  FROM numbered GROUP BY doc_id, label, exact, words, votes, span),
verified AS (
  SELECT *, found / votes AS coverage FROM spans
  WHERE CASE WHEN exact THEN found = votes ELSE found / votes >= {coverage} AND stop - start <= 2 * words END)
SELECT w.doc_id, CAST(len(any_value(ws)) AS BIGINT) AS n_words, count(*) FILTER (exact) AS n_base,
  CAST(min(start) FILTER (exact) AS BIGINT) AS first_word, CAST(max(start) FILTER (exact) AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (exact)), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list(DISTINCT label) FILTER (label IS NOT NULL)), ','), '') AS labels,
  CAST(coalesce(max(coverage), 0) AS DOUBLE) AS score
FROM w LEFT JOIN verified v ON w.doc_id = v.doc_id GROUP BY w.doc_id
"""


SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, {_spaced("coalesce(text, '')")} AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i+12], ' ') AS key FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY key) < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS place FROM repeated, range(0, 13) AS r(j)),
places AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS place FROM w),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.place) AS text, count(*) AS n FROM places p
  ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY p.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""


def _linked(words: int, percent: int, columns: str) -> str:
    """Documents with the components of their links, from every pair that shares a shingle."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {_spaced(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i+{words - 1}], ' ') AS s FROM (
    SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {words - 1}, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= {percent} * (x.n + y.n - c.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM w
  UNION SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON r.other = l.a)
SELECT w.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id{columns}
FROM w JOIN reached r ON w.doc_id = r.doc_id LEFT JOIN sizes s ON w.doc_id = s.doc_id GROUP BY w.doc_id
"""


NEAR_DEDUP = _linked(3, 85, ", w.doc_id = min(other) AS kept")
PARITY_JOIN = _linked(4, 85, "")

DECONTAMINATION = f"""
WITH w AS (SELECT doc_id, {_letters('text')} AS ws FROM documents),
items AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM (SELECT item_id, {_letters('text')} AS ws FROM benchmark) WHERE len(ws) > 0),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i+n-1], ' ') AS key FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM items)),
lengths AS (SELECT DISTINCT n FROM items),
windows AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i+n-1], ' ') AS key FROM (
    SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, lengths WHERE len(ws) >= n)),
found AS (SELECT doc_id, i, d.n, item_id FROM windows d JOIN item_windows t ON d.n = t.n AND d.key = t.key),
hit AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, n)) AS j FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS names FROM found GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(names), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(names, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit ON w.doc_id = hit.doc_id LEFT JOIN named ON w.doc_id = named.doc_id
"""

# CRC-32 of the digits of an id, bit by bit: -1 shifts, another number is a byte.
PERIODIC_RUNS = f"""
WITH hashed AS (
  SELECT doc_id, {_spaced("coalesce(text, '')")} AS ws, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END)) AS h FROM documents),
parts AS (SELECT doc_id, ws, len(ws) AS n, h % 10 = 0 AND len(ws) > 0 AS planted, (h // 10) % greatest(len(ws), 1) AS a, h // 10 AS g FROM hashed),
shaped AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM parts),
words AS (
  SELECT doc_id, list_transform(range(0, n), lambda i: ws[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END]) AS ws FROM shaped),
grams AS (
  SELECT doc_id, i, array_to_string(ws[i+1:i+6], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 5)) AS i FROM words WHERE len(ws) >= 6)),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS period FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, period ORDER BY i) AS island FROM pairs),
stretches AS (SELECT doc_id, period, min(i) AS start, count(*) + 5 + period AS length FROM islands GROUP BY doc_id, period, island),
runs AS (
  SELECT doc_id, start, length, min(period) AS period FROM stretches WHERE length >= 12 AND length >= 2 * period GROUP BY doc_id, start, length),
figures AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
    list(struct_pack(length := length, start := start, period := period) ORDER BY length DESC, start, period)[1] AS best
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
places AS (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS i FROM words),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.i) AS text FROM places p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
  1000 * best.length // best.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM words w LEFT JOIN figures f ON w.doc_id = f.doc_id LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

ORACLE = {
    "op2_license_scan": _license_scan(),
    "op3_substring_dedup": SUBSTRING_DEDUP,
    "op4_near_dedup": NEAR_DEDUP,
    "op6_quality_rules": QUALITY_RULES,
    "op8_url_filter": URL_FILTER,
    "op9_decontamination": DECONTAMINATION,
    "op12_periodic_runs": PERIODIC_RUNS,
    "op13_parity_join": PARITY_JOIN,
}
