"""DuckDB SQL for the queries that SQL can express over whole tables.

op3 (a backoff model), op5 (packing), op6 and op7 (tokenizer, HTML), op8 and op13 (fitted models) and op11
(a cheapest path per conversation) have none; they are tested against brute-force versions.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {}

ORACLE["op1_url_filter"] = rf"""
WITH r(rule_host, rule_path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, {_FOLD.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT page_id, rule_host || rule_path AS rule, verdict,
             row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, verdict DESC, rule_host || rule_path) AS n
      FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM p LEFT JOIN f ON p.page_id = f.page_id AND f.n = 1
"""

ORACLE["op2_ngram_join"] = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
g AS (SELECT doc_id, unnest(s) AS g FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM n UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON reach.other = ways.a)
SELECT n.doc_id, n.n AS n_shingles, min(other) AS component_id FROM n JOIN reach USING (doc_id) GROUP BY 1, 2
"""

ORACLE["op4_substring_dedup"] = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
spot AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13),
t AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS k FROM spot),
m AS (SELECT k, min(doc_id) AS low FROM t GROUP BY k),
c AS (SELECT DISTINCT doc_id, p FROM (SELECT t.doc_id, unnest(range(t.i, t.i + 13)) AS p FROM t JOIN m USING (k) WHERE low < t.doc_id)),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM w),
k AS (SELECT x.doc_id, count(c.p) AS removed, string_agg(word, ' ' ORDER BY x.p) FILTER (c.p IS NULL) AS kept
      FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.p = c.p GROUP BY x.doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""

ORACLE["op9_quality"] = rf"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines FROM documents),
spot AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3),
t AS (SELECT doc_id, i, array_to_string(w[i:i+2], ' ') AS k FROM spot),
again AS (SELECT doc_id, k FROM t GROUP BY doc_id, k HAVING count(*) > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT t.doc_id, unnest(range(t.i, t.i + 3)) AS p FROM t JOIN again USING (doc_id, k)) GROUP BY doc_id),
m AS (SELECT w.doc_id, host, len(w.w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN c ON w.doc_id = c.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             10 * n_symbols > 3 * n_words OR 100 * n_repeat_words > 30 * n_words OR n_dup_lines >= 3
             OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS soft FROM m),
h AS (SELECT host, count(*)::DOUBLE AS n, count(*) FILTER (base_failed OR soft)::DOUBLE AS failed FROM f GROUP BY host),
a AS (SELECT sum(failed) / sum(n) AS mu, sum(n) AS sn, count(*) AS hosts, sum(failed * failed / n) AS sq, sum(n * n) AS nn FROM h),
b AS (SELECT mu, hosts, sn - nn / sn AS freedom, sq - sn * mu * mu - (hosts - 1) * mu * (1 - mu) AS over FROM a),
p AS (SELECT mu, CASE WHEN hosts > 1 AND freedom > 0 AND over / freedom > 0
             THEN least(1e6, greatest(0.01, mu * (1 - mu) / (over / freedom) - 1)) ELSE 1e6 END AS weight FROM b),
s AS (SELECT host, (failed + weight * mu) / (n + weight) > 0.5 AS strict FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT (strict AND soft) AS kept
FROM f JOIN s USING (host)
"""

ORACLE["op10_hamming_topk"] = """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS c FROM embeddings WHERE len(embedding) = 64),
d AS (SELECT q.vec_id AS query_id, r.vec_id AS neighbour_id,
             list_sum(list_transform(range(1, 65), lambda i: CASE WHEN q.c[i] <> r.c[i] THEN 1 ELSE 0 END))::INTEGER AS distance
      FROM c q, c r WHERE q.vec_id % 50 = 0),
n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id)::INTEGER AS rank FROM d)
SELECT query_id, rank, neighbour_id, distance FROM n WHERE rank <= 10
"""

# crc32 of a text, byte by byte: a byte is mixed in, then eight bits are shifted out
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
  range(1, octet_length(encode({0})) + 1), lambda i: list_prepend(ascii(substr({0}, i, 1))::BIGINT, list_transform(range(8), lambda j: -1::BIGINT))))),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""

ORACLE["op12_prefix_trie"] = f"""
WITH c AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
             sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), octet_length(encode(coalesce(text, '')))) AS p
           FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC.format("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM c)),
b AS (SELECT i.conv_id, c.p, c.r, c.t FROM i JOIN c ON c.conv_id = i.base WHERE c.p <= i.h
      UNION ALL SELECT i.conv_id, c.p, c.r, c.t FROM i JOIN c ON c.conv_id = i.conv_id WHERE c.p > i.h),
l AS (SELECT conv_id, list({{'r': r, 't': t}} ORDER BY p) AS s FROM b GROUP BY conv_id),
s AS (SELECT i.conv_id, coalesce(s, []) AS s FROM i LEFT JOIN l USING (conv_id)),
m AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM s),
g AS (SELECT s[1:d] AS k, d AS depth, min(conv_id) AS conv_id, count(*) AS n,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = d), '')) AS ends FROM m GROUP BY 1, 2),
o AS (SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY 1),
v AS (SELECT g.*, coalesce(n_children, 0) AS n_children,
             CASE WHEN depth > 0 THEN (n - 1) * octet_length(encode(g.k[depth].t)) ELSE 0 END AS own FROM g LEFT JOIN o ON g.k = o.k),
a AS (SELECT k[1:d] AS k, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(own)::BIGINT AS saved
      FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM v) GROUP BY 1)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n AS n_convs, v.n_children, a.n_leaves, a.saved AS saved_tokens, v.ends AS ends_sha256
FROM v JOIN a ON v.k = a.k LEFT JOIN g p ON v.depth > 0 AND p.k = v.k[1:v.depth - 1]
"""
