"""DuckDB text that recomputes the queries by other means."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op4_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text,
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
cut AS (
  SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, cut.n, item FROM cut JOIN windows ON cut.win = windows.win),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (
  SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_METRICS = r"""
d AS (SELECT doc_id, source, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, list_slice(w, i, i + 2) AS win FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS seen FROM windows),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again WHERE seen > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
  CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id))
"""

ORACLES["op6_quality_rules"] = "WITH " + _METRICS + r""",
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words
  OR (n_words > 0 AND n_symbols > 0.5 * n_words)
  OR (n_words > 0 AND (word_chars / n_words < 2 OR word_chars / n_words > 14))
  OR n_dup_lines > 0.5 * n_lines AS failed FROM m),
h AS (SELECT source, count(*) AS n, sum(CAST(failed AS INT)) AS f FROM f GROUP BY source),
p AS (SELECT sum(f) / sum(n) AS mu, greatest(sum((f / n) * (f / n) * n) / sum(n)
  - (sum(f) / sum(n)) * (sum(f) / sum(n)), 0) AS spread, count(*) AS k, sum(n) AS total FROM h),
q AS (SELECT mu, spread - mu * (1 - mu) * k / total AS gap FROM p),
s AS (SELECT mu, CASE WHEN gap * 1000000.0 <= mu * (1 - mu) THEN 1000000.0
  ELSE greatest(mu * (1 - mu) / gap - 1, 0) END AS strength FROM q),
v AS (SELECT source, (f + mu * strength) / (n + strength) > 0.6 AS rejected FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT rejected AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""


def _secrets_sql() -> str:
    """Spans by splitting at matches, entropies by counting every window anew."""
    kinds = {
        "assign": (0, r"(?i:(password|passwd|secret|token|api_?key))[""" + '"' + r"'']?\x20*[:=]\x20*["
                   + '"' + r"'']?([A-Za-z0-9+/_.=-]+)"),
        "access": (1, r"AKIA[A-Z0-9]+"), "hex": (2, r"[0-9a-f]+"),
        "entropy_hex": (3, r"[0-9a-fA-F]{20,}"), "entropy_base64": (4, r"[A-Za-z0-9+/_=-]{20,}"),
    }
    placed = " UNION ALL ".join(f"""
      SELECT doc_id, '{kind}' AS kind, {rank} AS rank, k, found,
        before + coalesce(sum(length(found)) OVER (PARTITION BY doc_id ORDER BY k
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM (SELECT doc_id, k, found, sum(length(piece)) OVER (
              PARTITION BY doc_id ORDER BY k) AS before
            FROM (SELECT doc_id, unnest(range(1, len(f) + 1)) AS k, unnest(f) AS found,
                    unnest(p[1:len(f)]) AS piece
                  FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS f,
                          string_split_regex(t, '{pattern}') AS p FROM d)))"""
                               for kind, (rank, pattern) in kinds.items())
    repeated = "|".join(f"{c}{{8}}" if c.isalnum() else f"[{c}]{{8}}" for c in
                        "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-")
    harmless = ("(?i)example|placeholder|dummy|changeme|your[_-]",
                "0123456789|12345678|abcdefgh|ABCDEFGH", repeated,
                "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
                "^//|^/?(?:[a-z0-9_-]+/){2,}")
    excused = " OR ".join(f"regexp_matches(found, '{h}')" for h in harmless)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({placed}),
base AS (SELECT doc_id, start, rank, start + length(found) AS stop, kind FROM m
  WHERE kind = 'assign' AND length(regexp_extract(found, '{kinds["assign"][1]}', 2)) >= 8
    OR kind = 'access' AND length(found) >= 16 OR kind = 'hex' AND length(found) >= 32),
runs AS (SELECT * FROM m WHERE rank >= 3 AND NOT ({excused}) AND regexp_matches(found, '[0-9]')
  AND (rank <> 3 OR regexp_matches(found, '[a-fA-F]'))
  AND (rank <> 4 OR (regexp_matches(found, '[A-Z]') AND regexp_matches(found, '[a-z]')))),
cut AS (SELECT doc_id, kind, rank, k, start, i, substr(found, i + 1, 20) AS win FROM (
  SELECT *, unnest(range(0, length(found) - 19)) AS i FROM runs)),
symbols AS (SELECT doc_id, kind, k, i, c, count(*) AS n FROM (
  SELECT doc_id, kind, k, i, unnest(string_split(win, '')) AS c FROM cut) GROUP BY ALL),
sums AS (SELECT doc_id, kind, k, i, sum(CAST(round(n * log2(n) * 1000000) AS BIGINT)) AS s
  FROM symbols GROUP BY ALL),
hot AS (SELECT doc_id, kind, rank, k, start, i FROM cut JOIN sums USING (doc_id, kind, k, i)
  WHERE s <= CAST(floor((log2(20) - CASE rank WHEN 3 THEN 3.0 ELSE 3.9 END) * 20 * 1000000) AS BIGINT)),
marked AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id, kind, k ORDER BY i) + 20
  THEN 0 ELSE 1 END AS fresh FROM hot),
island AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, kind, k ORDER BY i) AS g FROM marked),
more AS (SELECT doc_id, start + min(i) AS start, rank, start + max(i) + 20 AS stop, kind
  FROM island GROUP BY doc_id, kind, rank, k, start, g),
spans AS (SELECT *, rank < 3 AS is_base, concat_ws(':', kind, CAST(start AS BIGINT), CAST(stop AS BIGINT)) AS label
  FROM (SELECT * FROM base UNION ALL SELECT * FROM more)),
byd AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
  count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(label, ',' ORDER BY start, rank, stop) FILTER (is_base) AS base,
  string_agg(label, ',' ORDER BY start, rank, stop) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN byd USING (doc_id)
"""


ORACLES["op1_secrets"] = _secrets_sql()

# DuckDB has no base32; the 160 bits are cut into 32 groups of five.
ORACLES["op7_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, h,
  list_reduce(list_transform(string_split(sha1(h), ''), lambda x: lpad(bin(
    instr('0123456789abcdef', x) - 1), 4, '0')), lambda a, b: a || b) AS bits FROM p),
b AS (SELECT *, list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
    + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
    + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)), lambda a, b: a || b) AS payload_digest,
  max(page_id) OVER (PARTITION BY h) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to FROM b
"""

# CRC-32 (reflected polynomial 0xEDB88320) of the decimal id: each byte, then eight shifts.
ORACLES["op12_periodic_runs"] = r"""
WITH s AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
    string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) AS h
  FROM documents),
g AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS planted, (h // 10) AS g,
  CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM s),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g),
word AS (SELECT doc_id, n, i, CASE WHEN planted AND i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM p)),
-- A run has at least three neighbouring places i with equal words at i and i + q.
gram AS (SELECT doc_id, n, i, word, lead(word) OVER d AS b, lead(word, 2) OVER d AS c
  FROM word WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
equal AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM gram x JOIN gram y
  ON x.doc_id = y.doc_id AND x.word = y.word AND x.b = y.b AND x.c = y.c
  AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
stretch AS (SELECT doc_id, q, min(i) AS start, max(i) - min(i) + 3 + q AS length FROM (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal)
  GROUP BY doc_id, q, island),
run AS (SELECT doc_id, start, length, min(q) AS period FROM stretch
  WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
listed AS (SELECT doc_id, count(*) AS n_runs,
  string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM run GROUP BY doc_id),
best AS (SELECT doc_id, start, length, period FROM run r QUALIFY row_number() OVER (
  PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
rest AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM word ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id)
SELECT s.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
  length * 1000 // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
  sha256(coalesce(words, '')) AS collapsed_sha256
FROM s LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN rest USING (doc_id)
"""

ORACLES["op11_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 49), ' ')) AS win FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
later AS (SELECT doc_id, i FROM (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS least FROM windows) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM later),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS words
  FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

ORACLES["op13_collocations"] = r"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
gram AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_slice(w, i, i + k - 1))) AS g
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, g, count(*) AS a FROM gram GROUP BY lang, k, g HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
cut AS (SELECT c.lang, c.k, c.g, c.a, i AS cut, x.a AS l, y.a AS r,
    CAST((2000000::HUGEINT * c.a) // (x.a::HUGEINT + y.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS i FROM f WHERE k > 1) c
  JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, i)
  JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, i + 1, c.k)),
weak AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
part AS (SELECT lang, a, k, len, unnest(list_transform(range(1, k - len + 2), lambda i: list_slice(g, i, i + len - 1))) AS g
  FROM (SELECT *, unnest(range(2, k)) AS len FROM f WHERE k > 2)),
inside AS (SELECT DISTINCT weak.lang, weak.g FROM weak JOIN part ON part.lang = weak.lang AND part.g = weak.g
  WHERE 100 * part.a >= 80 * weak.a),
ranked AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
  FROM weak ANTI JOIN inside USING (lang, g))
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
