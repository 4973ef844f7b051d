"""SQL in DuckDB's dialect for the operators that SQL can express over whole tables."""

from __future__ import annotations

from mixspark.llm.quality import ERROR, LEVELS, RISK, setting

GAP = r"[\x20\x09-\x0D]+"
NEAR_DUPLICATES = rf"""
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{GAP}'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT a AS node, b AS other FROM both_ways UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.other = e.a),
comp AS (SELECT node, min(other) AS root FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id, d.doc_id = coalesce(root, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN comp ON node = d.doc_id"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= 20"""

#: The rules' values in SQL, by name.
VALUES = {
    "symbols": "CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END",
    "dup_lines": "CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END",
    "repeats": "CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END",
    "capitals": "CASE WHEN word_chars > 0 THEN n_capitals / word_chars ELSE 0 END",
    "points": "CASE WHEN word_chars > 0 THEN n_points / word_chars ELSE 0 END",
    "long_words": "CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END",
    "short_words": "CASE WHEN n_words > 0 THEN -(word_chars / n_words) ELSE 0 END",
}
_GRID = ", ".join(f"({level}, '{rule}', CAST({cut} AS DOUBLE))" for level in range(LEVELS) for rule, cut in setting(level).items())
_VALUE = "CASE rule " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in VALUES.items()) + " END"


def _without(text: str, chars: str) -> str:
    return f"length({text}) - length(translate({text}, '{chars}', ''))"


QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(t, '{GAP}'), lambda x: x <> '') AS w FROM d),
pos AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w),
win AS (SELECT doc_id, i, w[i:i + 2] AS k FROM pos),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS r FROM twice, (VALUES (0), (1), (2)) x(o) GROUP BY doc_id),
ln AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (SELECT doc_id, stratum, len(w) AS n_words, coalesce(CAST(list_sum(list_transform(w, lambda x: length(x))) AS BIGINT), 0) AS word_chars, {_without("t", "#*$%&|<>")} AS n_symbols,
        len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r, 0) AS n_repeat_words, len(l) AS n_lines, {_without("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")} AS n_capitals, {_without("t", "!?.,;:")} AS n_points
      FROM d JOIN w USING (doc_id) JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
grid(level, rule, cutoff) AS (VALUES {_GRID}),
beyond AS (SELECT doc_id, level, bool_or({_VALUE} > cutoff) AS out FROM b, grid GROUP BY ALL),
held AS (SELECT * FROM b WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
cnt AS (SELECT stratum, level, count(*) AS n, count(*) FILTER (out) AS k FROM held JOIN beyond USING (doc_id) GROUP BY ALL),
tail AS (SELECT *, (SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK}) + (n - j) * ln(1 - {RISK}))) FROM range(0, k + 1) r(j)) AS cdf FROM cnt),
chosen AS (SELECT stratum, max(level) AS level FROM tail WHERE cdf <= {ERROR} / (SELECT count(DISTINCT stratum) FROM held) GROUP BY stratum),
bad AS (SELECT doc_id FROM b JOIN chosen USING (stratum) JOIN beyond USING (doc_id, level) WHERE out)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, n_points, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM b"""

#: CRC-32 of a decimal number: the table by its rule, then one step a digit.
_CRC_TABLE = "SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc"


def _crc32(number: str) -> str:
    digits = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {digits}), lambda c, d: xor(c >> 8, crc[1 + (xor(c, d) & 255)])))"


PREFIX_TRIE = f"""
WITH crc AS ({_CRC_TABLE}),
turns AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS i, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, n, {_crc32("c")} % 9 AS h, c - c % 5 AS opening FROM (SELECT c, count(*) AS n FROM turns GROUP BY c), crc),
again AS (
  SELECT v.c, t.i AS pos, role, t FROM convs v JOIN turns t ON t.c = v.opening AND t.i < v.h
  UNION ALL
  SELECT v.c, t.i - v.h + least(v.h, coalesce(o.n, 0)), role, t FROM convs v JOIN turns t ON t.c = v.c AND t.i >= v.h LEFT JOIN convs o ON o.c = v.opening),
paths AS (SELECT c, pos + 1 AS d, string_agg(md5(role || chr(1) || t), '') OVER (PARTITION BY c ORDER BY pos) AS k, strlen(t) AS bytes FROM again
          UNION ALL SELECT c, 0, '', 0 FROM convs),
nodes AS (SELECT k, d, min(c) AS c, count(*) AS n, any_value(bytes) AS bytes FROM paths GROUP BY k, d),
kids AS (SELECT left(k, -32) AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
sums AS (SELECT p.k, sum(CASE WHEN kids.k IS NULL THEN 1 ELSE 0 END) AS leaves, sum((n.n - 1) * n.bytes) AS saved
         FROM nodes n JOIN paths p ON p.c = n.c AND p.d <= n.d LEFT JOIN kids ON kids.k = n.k GROUP BY p.k),
ends AS (SELECT k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM paths WHERE (c, d) IN (SELECT c, max(d) FROM paths GROUP BY c) GROUP BY k)
SELECT n.c AS conv_id, n.d AS depth, p.c AS parent_conv_id, n.n AS n_convs, coalesce(n_children, 0) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.d > 0 AND p.k = left(n.k, -32) LEFT JOIN kids ON kids.k = n.k JOIN sums ON sums.k = n.k LEFT JOIN ends ON ends.k = n.k"""

PERIODIC_RUNS = rf"""
WITH crc AS ({_CRC_TABLE}),
d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{GAP}'), lambda x: x <> '') AS w, {_crc32("doc_id")} AS h FROM documents, crc),
a AS (SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS m FROM d),
w AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(w, lambda x, i: CASE WHEN i > a THEN w[1 + a + (i - 1 - a) % (1 + (n - a) // m)] ELSE x END) ELSE w END AS w FROM a),
x AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM w),
pairs AS (SELECT l.doc_id, l.i, r.i - l.i AS q FROM x l JOIN x r ON l.doc_id = r.doc_id AND l.x = r.x AND r.i > l.i),
islands AS (SELECT doc_id, q, min(i) AS s, max(i) + 1 + q AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM pairs) GROUP BY doc_id, q, g),
runs AS (SELECT doc_id, s, e, min(q) AS q FROM islands WHERE e - s >= greatest(12, 2 * q) GROUP BY doc_id, s, e),
told AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM runs GROUP BY doc_id),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY e - s DESC, s, q) = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, e)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.e - b.s AS length, b.q AS period, 1000 * (b.e - b.s) // b.q AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN told ON told.doc_id = d.doc_id LEFT JOIN best b ON b.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

ORACLES: dict[str, str] = {"op2_minhash": NEAR_DUPLICATES, "op6_top_k": TOP_K, "op7_quality": QUALITY, "op11_prefix_trie": PREFIX_TRIE, "op13_periodic_runs": PERIODIC_RUNS}
