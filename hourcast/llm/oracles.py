"""DuckDB SQL of the operators that SQL can express, over whole tables and texts."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

JACCARD = f"""
WITH RECURSIVE
words AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_SPACED}) AS w FROM documents),
shingles AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
classes AS (
  SELECT min(doc_id) AS c, list_sort(s) AS s, list(doc_id) AS members FROM shingles GROUP BY list_sort(s)),
tokens AS (SELECT c, len(s) AS n, hash(unnest(s)) AS t FROM classes WHERE len(s) > 0),
links AS (
  SELECT a.c AS a, b.c AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.c <> b.c
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT c, c AS r FROM classes
  UNION SELECT reach.c, links.b FROM reach JOIN links ON reach.r = links.a),
named AS (SELECT c, min(r) AS component_id FROM reach GROUP BY c),
placed AS (SELECT unnest(members) AS doc_id, c, len(s) AS n FROM classes)
SELECT p.doc_id, CAST(p.n AS BIGINT) AS n_shingles, CASE WHEN p.n = 0 THEN p.doc_id ELSE named.component_id END AS component_id
FROM placed p JOIN named ON named.c = p.c
"""

QUALITY = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w,
    row_number() OVER () AS k FROM documents),
lines AS (
  SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {_SPACED})) AS ls FROM base),
windows AS (
  SELECT k, i, [w[i], w[i + 1], w[i + 2]] AS x FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, x) AS c FROM windows) WHERE c > 1),
covered AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY k),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM lines LEFT JOIN covered USING (k)),
f AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
    + 8 * (n_lines > 1 AND 100 * n_dup_lines > 30 * n_lines)::INT + 16 * (word_chars < 3 * n_words)::INT
    + 32 * (word_chars > 12 * n_words)::INT + 64 * (n_words > 100000)::INT + 128 * (100 * n_repeat_words > 30 * n_words)::INT
    + 256 * (n_dup_lines > 1 AND 100 * n_dup_lines > 30 * n_lines)::INT AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed,
  (failed & 63) = 0 AS kept, failed FROM f
"""

DECONTAMINATE = f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_LOWER.format('text')}, {_ALNUM}) AS w FROM benchmark
  WHERE item_id IS NOT NULL AND text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS x
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
docs AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_ALNUM}) AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT k, n, i, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
hits AS (SELECT k, i, n, item_id FROM places JOIN windows USING (n, x)),
words AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM hits) GROUP BY k),
found AS (
  SELECT k, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT k, item_id FROM hits) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words USING (k) LEFT JOIN found USING (k)
"""

FILL_IN_MIDDLE = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
numbers AS (
  SELECT *, CAST(len(w) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(w) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(w) + 1) AS y,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM base),
parts AS (
  SELECT doc_id, n, form, t, array_to_string(w[1:least(x, y)], '') AS prefix, array_to_string(w[least(x, y) + 1:greatest(x, y)], '') AS middle,
    array_to_string(w[greatest(x, y) + 1:], '') AS suffix FROM numbers)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256 FROM parts
"""

# CRC-32 of the decimal id, bit by bit: a byte is XORed in, then eight shifts (-1) follow it.
_CRC32 = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST({0} AS VARCHAR), ''),
      lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, o: CASE WHEN o >= 0 THEN xor(crc, o) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END), CAST(4294967295 AS BIGINT))"""

PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 100 AS family, {_CRC32.format("c")} % 6 AS h FROM (SELECT DISTINCT conv_id AS c FROM turns)),
rebuilt AS (
  SELECT c, 0 AS part, pos, role, text FROM convs JOIN turns ON conv_id = family AND pos <= h
  UNION ALL SELECT c, 1, pos, role, text FROM convs JOIN turns ON conv_id = c AND pos > h),
numbered AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, role, text FROM rebuilt),
members AS (
  SELECT c, d, length(text) AS chars, md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '')
    OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS k FROM numbered
  UNION ALL SELECT c, 0, 0, '' FROM convs),
linked AS (
  SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS up, d = max(d) OVER (PARTITION BY c) AS ends FROM members),
nodes AS (
  SELECT d, k, min(up) AS up, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS saved,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256 FROM linked GROUP BY d, k),
children AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
own AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (d, k)),
totals AS (
  SELECT a.d, a.k, sum(CASE WHEN own.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(own.saved) AS saved_tokens
  FROM own JOIN members a ON a.c = own.conv_id AND a.d <= own.d GROUP BY a.d, a.k)
SELECT own.conv_id, own.d AS depth, p.conv_id AS parent_conv_id, own.n_convs, own.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, own.ends_sha256
FROM own JOIN totals USING (d, k) LEFT JOIN nodes p ON p.d = own.d - 1 AND p.k = own.up
"""

ORACLE_SQL = {
    "op2_ngram_jaccard_join": JACCARD.strip(),
    "op8_quality_rules": QUALITY.strip(),
    "op10_benchmark_decontamination": DECONTAMINATE.strip(),
    "op11_conversation_prefix_trie": PREFIX_TRIE.strip(),
    "op12_fill_in_middle": FILL_IN_MIDDLE.strip(),
}
