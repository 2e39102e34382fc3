"""DuckDB statements of the queries that SQL can express."""

OP2 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS gram FROM b WHERE len(w) > 0),
x AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS pos, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS gram
      FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n),
h AS (SELECT x.doc_id, x.pos, x.n, g.item_id FROM x JOIN g USING (n, gram)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
"""

OP3 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' ')))) AS shingles FROM d WHERE len(w) > 0),
k AS (SELECT doc_id, len(shingles) AS n, min(doc_id) OVER (PARTITION BY md5(array_to_string(shingles, chr(10)))) AS class FROM s),
x AS (SELECT doc_id AS class, len(shingles) AS n, unnest(shingles) AS shingle FROM s WHERE doc_id IN (SELECT class FROM k)),
l AS (SELECT a.class AS a, b.class AS b FROM x a JOIN x b ON a.shingle = b.shingle AND a.class < b.class
      GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT DISTINCT class AS a, class AS b FROM k UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS class, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       coalesce(c.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN c USING (class)
"""

OP4 = """
WITH s AS (SELECT coalesce('=' || source, '') AS source_, sum(length(coalesce(text, ''))) AS chars FROM documents GROUP BY 1),
r AS (SELECT source_, CASE WHEN chars > 0 THEN (1.0::DOUBLE / (count(*) OVER ())) * (sum(chars) OVER ())::DOUBLE / chars::DOUBLE ELSE 1.0::DOUBLE END AS rate FROM s),
k AS (SELECT source_, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM r),
p AS (SELECT source_, k, exp(k * ln(rate) - rate - sum(CASE WHEN k > 0 THEN ln(k::DOUBLE) ELSE 0.0 END) OVER (PARTITION BY source_ ORDER BY k)) AS p FROM k),
c AS (SELECT source_, sum(p) OVER (PARTITION BY source_ ORDER BY k) AS cdf FROM p),
d AS (SELECT doc_id, text, source, coalesce('=' || source, '') AS source_, ('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM documents),
n AS (SELECT doc_id, any_value(text) AS text, any_value(source) AS source, CAST(count(*) AS INTEGER) AS n_copies FROM d JOIN c USING (source_) WHERE u >= cdf GROUP BY doc_id),
e AS (SELECT *, CAST(unnest(range(0, n_copies)) AS INTEGER) AS copy_no FROM n)
SELECT doc_id, text, source, n_copies, copy_no, md5('mix-1:order:' || CAST(doc_id AS VARCHAR) || ':' || CAST(copy_no AS VARCHAR)) AS shuffle_key FROM e
"""

_ESCAPED = "length(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'))"
OP9 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(16 + {_ESCAPED.format('role')} + {_ESCAPED.format('text')}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP10 = r"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS pos, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS gram FROM d WHERE len(w) > 2),
m AS (SELECT doc_id, unnest(range(pos, pos + 3)) AS pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_repeat_words FROM m GROUP BY doc_id),
b AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM d LEFT JOIN p USING (doc_id)),
n AS (SELECT DISTINCT host, t, list_transform(lines, lambda x: trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g'))) AS lines FROM d),
o AS (SELECT host, t, unnest(lines) AS line FROM n),
f AS (SELECT host, line FROM o GROUP BY host, line HAVING count(DISTINCT t) > 20),
q AS (SELECT host, t FROM o LEFT JOIN (SELECT host, line, true AS often FROM f) USING (host, line) GROUP BY host, t
      HAVING 100 * sum(CASE WHEN often THEN 0 ELSE length(line) END) < 30 * sum(length(line)))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND (host, t) NOT IN (SELECT (host, t) FROM q) AS kept
FROM d JOIN b USING (doc_id)
"""

OP11 = r"""
WITH t AS (SELECT conv_id, md5(CAST(strlen(r) AS VARCHAR) || ':' || r || x) AS k, strlen(x) AS b, row_number() OVER (
             PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(CAST(strlen(r) AS VARCHAR) || ':' || r || x)) AS n
           FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
        lambda a, x: list_reduce(list_prepend(xor(a, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))
      ), 4294967295) % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, n, k, b FROM c JOIN t ON t.conv_id = base AND n <= h
      UNION ALL SELECT c.conv_id, 1, n, k, b FROM c JOIN t ON t.conv_id = c.conv_id AND n > h),
p AS (SELECT conv_id, 0 AS depth, '' AS p, 0 AS b FROM c
      UNION ALL SELECT conv_id, row_number() OVER w, string_agg(k, '') OVER w, b FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, n)),
m AS (SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(b) AS saved FROM p GROUP BY p, depth),
q AS (SELECT left(p, 32 * (depth - 1)) AS p, count(*) AS n_children FROM m WHERE depth > 0 GROUP BY 1),
u AS (SELECT left(p, CAST(32 * d AS INTEGER)) AS p, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
      FROM (SELECT p, n_children, saved, unnest(range(0, depth + 1)) AS d FROM m LEFT JOIN q USING (p)) GROUP BY 1),
e AS (SELECT p, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
      FROM (SELECT conv_id, arg_max(p, depth) AS p FROM p GROUP BY conv_id) GROUP BY p)
SELECT m.conv_id, CAST(m.depth AS BIGINT) AS depth, o.conv_id AS parent_conv_id, m.n_convs, coalesce(n_children, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM m LEFT JOIN q USING (p) JOIN u USING (p) LEFT JOIN e USING (p)
LEFT JOIN m AS o ON m.depth > 0 AND o.depth = m.depth - 1 AND o.p = left(m.p, CAST(32 * (m.depth - 1) AS INTEGER))
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS row_, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT row_, doc_id, unnest(range(1, len(lines) + 1)) AS n, unnest(lines) AS line FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT row_) >= 5),
x AS (SELECT k.*, f.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS lost FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(count_if(lost) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM x GROUP BY row_
"""

OP13 = r"""
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, a.label = v.label AS same, v.id, CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score FROM v AS a JOIN v ON a.id % 100 = 0 AND a.id <> v.id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

ORACLES = {
    "op2_ngram_decontamination": OP2, "op3_minhash": OP3, "op4_poisson_mix": OP4, "op9_content_parts": OP9, "op10_line_frequency": OP10,
    "op11_prefix_trie": OP11, "op12_line_bloom": OP12, "op13_cover_tree": OP13,
}
