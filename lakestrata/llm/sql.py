"""DuckDB SQL with the rows of the queries that SQL can express, from the tables' texts alone."""

from __future__ import annotations

from lakestrata.llm import decontaminate as d
from lakestrata.llm import fim, neardup, resample, rules, substring

#: Words ``[^\x20\x09-\x0D]+`` of a text, null having none.
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_SPAN = substring.SPAN
SUBSTRING = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + {_SPAN - 1}], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {_SPAN - 2})) AS i FROM w)),
firsts AS (SELECT k, min(doc_id) AS m FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, i + j AS p
  FROM windows JOIN firsts USING (k), range(0, {_SPAN}) t(j) WHERE doc_id > m),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""


def _fence(end: str) -> str:
    parts = []
    for k, (least, both) in rules.MEASURES.items():
        spread = f"{rules.SPREADS} * greatest({k}_75 - {k}_25, {least})"
        if end == "high":
            parts.append(f"{k}_75 + {spread} AS {k}_high")
        elif both:
            parts.append(f"{k}_25 - {spread} AS {k}_low")
    return ", ".join(parts)


def _fences(name: str, by: str, least: int) -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    ranked = ", ".join(f"row_number() OVER ({part} ORDER BY {k}) AS {k}_r" for k in rules.MEASURES)
    quartiles = ", ".join(
        f"max({k}) FILTER ({k}_r = greatest(1, ceil({q / 100} * n))) AS {k}_{q}" for k in rules.MEASURES for q in (25, 75))
    return f"""
{name} AS (
  SELECT {keys} {_fence('high')}, {_fence('low')}
  FROM (SELECT {keys} n, {quartiles}
        FROM (SELECT *, count(*) OVER ({part}) AS n, {ranked} FROM good) GROUP BY ALL)
  WHERE n >= {least})"""


def _inside() -> str:
    tests = []
    for k, (_, both) in rules.MEASURES.items():
        limit = lambda end, k=k: f"coalesce(own.{k}_{end}, of_lang.{k}_{end}, overall.{k}_{end})"
        tests.append(f"{k} <= {limit('high')}")
        if both:
            tests.append(f"{k} >= {limit('low')}")
    return " AND ".join(tests)


_W = rules.WINDOW
QUALITY = f"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, ws[i:i + {_W - 1}] AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {_W - 2})) AS i FROM w)),
repeats AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words
  FROM windows JOIN (SELECT doc_id, k FROM windows GROUP BY doc_id, k HAVING count(*) > 1) USING (doc_id, k), range(0, {_W}) t(j)
  GROUP BY doc_id),
m AS (
  SELECT doc_id, lang, source, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN repeats USING (doc_id)),
judged AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEATED_PERCENT} * n_words AS base_failed,
         word_chars / n_words::DOUBLE AS word_length, n_symbols / n_words::DOUBLE AS symbols_a_word,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines::DOUBLE ELSE 0 END AS repeated_lines,
         n_repeat_words / n_words::DOUBLE AS repeated_words
  FROM m),
good AS (SELECT * FROM judged WHERE NOT base_failed),
{_fences('own', 'lang, source', rules.MIN_ROWS)},
{_fences('of_lang', 'lang', rules.MIN_ROWS)},
{_fences('overall', '', 1)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({_inside()}, TRUE) AS kept
FROM judged j
LEFT JOIN own ON j.lang IS NOT DISTINCT FROM own.lang AND j.source IS NOT DISTINCT FROM own.source
LEFT JOIN of_lang ON j.lang IS NOT DISTINCT FROM of_lang.lang
LEFT JOIN overall ON TRUE"""

_GAP = d.GAP.replace("'", "''")


def _masked(rows: str, extra: str, place: str) -> str:
    parts = []
    for number, mask in enumerate((*d.MASKS, *d.MORE_MASKS, d.SHORT_MASK)):
        at = ", ".join(f"ws[i + {k}]" for k, c in enumerate(mask) if c == "1")
        only = f" WHERE item_words = {d.SHORTEST}" if mask == d.SHORT_MASK and rows == "items" else ""
        parts.append(f"SELECT {extra}, {number} AS mask, i - 1 AS {place}, [{at}] AS seed "
                     f"FROM (SELECT *, unnest(range(1, len(ws) - {len(mask) - 2})) AS i FROM {rows}{only})")
    return " UNION ALL ".join(parts)


DECONTAMINATION = f"""
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '{_GAP}'), lambda x: x <> '') AS ws FROM documents),
all_items AS (
  SELECT DISTINCT item_id, list_filter(string_split_regex(lower(text), '{_GAP}'), lambda x: x <> '') AS ws FROM benchmark),
items AS (SELECT *, len(ws) AS item_words FROM all_items WHERE len(ws) >= {d.SHORTEST}),
a AS ({_masked('items', 'item_id, ws', 'place')}),
b AS ({_masked('docs', 'doc_id', 'pos')}),
hits AS (SELECT DISTINCT doc_id, item_id, a.ws AS iw, pos - place AS shift FROM a JOIN b USING (mask, seed)),
cells AS (
  SELECT h.*, k, coalesce(k + shift >= 0 AND docs.ws[k + shift + 1] = iw[k + 1], FALSE) AS same
  FROM (SELECT *, unnest(range(0, len(iw))) AS k FROM hits) h JOIN docs USING (doc_id)),
sums AS (
  SELECT doc_id, item_id, iw, shift, k + 1 AS k, sum(CASE WHEN same THEN 1 ELSE -{d.PENALTY} END) OVER s AS p
  FROM cells WINDOW s AS (PARTITION BY doc_id, item_id, iw, shift ORDER BY k)
  UNION ALL SELECT doc_id, item_id, iw, shift, 0, 0 FROM hits),
best AS (
  SELECT i.doc_id, i.item_id, i.iw, i.shift, (j.p - i.p + {d.PENALTY} * (j.k - i.k)) // {d.PENALTY + 1} AS matched, i.k AS start, j.k AS stop
  FROM sums i JOIN sums j ON i.doc_id = j.doc_id AND i.item_id IS NOT DISTINCT FROM j.item_id AND i.iw = j.iw AND i.shift = j.shift
       AND i.k < j.k AND j.p >= i.p
  QUALIFY row_number() OVER (PARTITION BY i.doc_id, i.item_id, i.iw, i.shift ORDER BY matched DESC, start, stop) = 1),
long AS (
  SELECT b.doc_id, b.item_id, len(b.iw) AS item_words, min(c.k) + any_value(b.shift) AS first_word,
         any_value(b.stop) - min(c.k) AS overlap, any_value(b.matched) AS matched
  FROM best b JOIN cells c ON b.doc_id = c.doc_id AND b.item_id IS NOT DISTINCT FROM c.item_id AND b.iw = c.iw AND b.shift = c.shift
       AND c.same AND c.k >= b.start
  WHERE matched >= least({d.MIN_WORDS}, ceil(len(b.iw) * {d.MIN_SHARE}))
  GROUP BY b.doc_id, b.item_id, b.iw, b.shift),
runs AS (
  SELECT doc_id, i - 1 AS first_word, ws[i:i + n - 1] AS ws
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT len(ws) AS n FROM all_items WHERE len(ws) BETWEEN 1 AND {d.SHORTEST - 1}))),
short AS (
  SELECT doc_id, item_id, len(ws) AS item_words, min(first_word) AS first_word, len(ws) AS overlap, len(ws) AS matched
  FROM runs JOIN all_items USING (ws) GROUP BY doc_id, item_id, ws)
SELECT doc_id, item_id, item_words::INTEGER AS item_words, first_word::INTEGER AS first_word, overlap::INTEGER AS overlap,
       matched::INTEGER AS matched
FROM (SELECT * FROM long UNION ALL SELECT * FROM short)
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, first_word, item_words DESC) = 1"""

_S = neardup.SHINGLE
NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
shingles AS (
  SELECT doc_id, s, count(*) AS c
  FROM (SELECT doc_id, CASE WHEN len(ws) < {_S} THEN ws ELSE ws[i:i + {_S - 1}] END AS s
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - {_S - 2}))) AS i FROM w WHERE len(ws) > 0))
  GROUP BY doc_id, s),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.c AS x, b.c AS y, count(*) AS t
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
totals AS (SELECT doc_id, sum(c) AS total FROM shingles GROUP BY doc_id),
alone AS (
  SELECT a, b, any_value(ta.total) - sum(x * t) AS only_a, any_value(tb.total) - sum(y * t) AS only_b
  FROM common JOIN totals ta ON ta.doc_id = a JOIN totals tb ON tb.doc_id = b GROUP BY a, b),
links AS (
  SELECT a, b FROM (
    SELECT p.a, p.b, p.t / (any_value(only_a) / p.x + any_value(only_b) / p.y + sum(q.t * greatest(q.x / p.x, q.y / p.y))) AS part
    FROM common p JOIN common q ON p.a = q.a AND p.b = q.b JOIN alone ON alone.a = p.a AND alone.b = p.b
    GROUP BY p.a, p.b, p.x, p.y, p.t)
  GROUP BY a, b HAVING sum(part) >= {neardup.SIMILARITY}),
two_way AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM w
  UNION SELECT doc_id, two_way.b FROM reached JOIN two_way ON other = two_way.a),
classes AS (SELECT doc_id, min(other) AS class_id FROM reached GROUP BY doc_id)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM classes"""

_MARKED = "(" + " OR ".join(f"contains(t, '{m}')" for m in (fim.PREFIX, fim.SUFFIX, fim.MIDDLE)) + ")"


def _units(first: str, last: str) -> str:
    """The lines after the ``first`` and up to the ``last``, each with its line feed."""
    return (f"array_to_string(lines[{first} + 1:{last}], chr(10))"
            f" || CASE WHEN {last} > {first} AND ({last} < n OR ends_with(t, chr(10))) THEN chr(10) ELSE '' END")


FILL_IN_MIDDLE = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS lines,
         sha256('{fim.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
sized AS (
  SELECT *, (len(lines) - CASE WHEN t = '' OR ends_with(t, chr(10)) THEN 1 ELSE 0 END)::BIGINT AS n,
         {", ".join(f"('0x' || substr(h, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))}
  FROM docs),
places AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR {_MARKED} OR h3 % 100 >= {fim.RATE} THEN 'plain'
              WHEN h4 % 100 < {fim.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
  FROM sized),
parts AS (
  SELECT *, {_units('0', 'a')} AS prefix, {_units('a', 'b')} AS middle, {_units('b', 'n')} AS suffix FROM places)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
              WHEN 'psm' THEN '{fim.PREFIX}' || prefix || '{fim.SUFFIX}' || suffix || '{fim.MIDDLE}' || middle
              ELSE '{fim.SUFFIX}' || suffix || '{fim.PREFIX}' || prefix || '{fim.MIDDLE}' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""

_R = resample
RESAMPLING = f"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS crcs
  FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) t(i))),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
tests AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark),
words AS (SELECT r, unnest(ws) AS word FROM docs),
coded AS (
  SELECT word, hex(encode(word)) AS code FROM (SELECT word FROM words UNION SELECT word FROM tests)),
buckets AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(code) // 2),
                                                    lambda k: ('0x' || substr(code, 2 * k + 1, 2))::BIGINT)),
                               lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) % {_R.BUCKETS} AS bucket
  FROM coded, crc_table),
s AS (SELECT bucket, count(*) AS n FROM words JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM tests JOIN buckets USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM words) + {_R.BUCKETS})
                                 / (s.n + 1)::DOUBLE / ((SELECT count(*) FROM tests) + {_R.BUCKETS})))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
weighed AS (
  SELECT r, floor(sum(gain) / count(*))::BIGINT AS weight FROM words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{_R.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                   / 4294967296))))::BIGINT AS score
  FROM docs LEFT JOIN weighed USING (r)),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_features >= {_R.MIN_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {_R.PERCENT} * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN ranked USING (r)"""

ORACLE = {
    "op2_quality_rules": QUALITY,
    "op4_substring_dedup": SUBSTRING,
    "op5_near_duplicates": NEAR_DUPLICATES,
    "op9_decontamination": DECONTAMINATION,
    "op11_fill_in_middle": FILL_IN_MIDDLE,
    "op13_importance_resampling": RESAMPLING,
}
