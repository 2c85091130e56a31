"""Expected results in SQL, for the queries that SQL can express."""

ORACLES: dict[str, str] = {
    "op1_suffix_levels": """
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents),
windows AS (
    SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w
    FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)),
firsts AS (SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
repeated AS (SELECT doc_id, i FROM windows JOIN firsts USING (w) WHERE first_id < doc_id),
runs AS (  -- ranges of windows that follow each other by at most 50 bytes cover one range of bytes
    SELECT doc_id, min(i) AS low, max(i) + 50 AS high
    FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
          FROM (SELECT doc_id, i,
                       CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh
                FROM repeated))
    GROUP BY doc_id, run),
gaps AS (  -- what stays: before each run, and after the last one
    SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS a, low AS b FROM runs
    UNION ALL SELECT doc_id, max(high), max(n) FROM runs JOIN d USING (doc_id) GROUP BY doc_id),
kept AS (
    SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h
    FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op4_perspectives": """
WITH t AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, md5(role || chr(1) || content)) - 1 AS place
    FROM (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS content FROM conversations)),
speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE lower(role) <> 'system'),
m AS (
    SELECT s.conv_id, s.perspective, t.place, t.place // 1024 AS segment, t.content,
           CASE WHEN lower(t.role) = 'system' THEN 'system'
                WHEN t.role = s.perspective THEN 'assistant' ELSE 'user' END AS role, t.role AS name
    FROM speakers s JOIN t ON s.conv_id IS NOT DISTINCT FROM t.conv_id),
h AS (
    SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || name ELSE '' END || chr(10) AS head
    FROM m),
w AS (
    SELECT *, length(head) + length(content) + 11 AS size,
           sum(length(head) + length(content) + 11) OVER (
               PARTITION BY conv_id, perspective, segment ORDER BY place
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
    FROM h)
SELECT conv_id, perspective, segment::BIGINT AS segment, count(*)::BIGINT AS n_messages,
       string_agg(head || content || '<|im_end|>' || chr(10), '' ORDER BY place) AS text,
       string_agg(CASE WHEN role = 'assistant'
                       THEN (upto - size + length(head))::BIGINT::VARCHAR || '-' || upto::BIGINT::VARCHAR END,
                  ',' ORDER BY place) AS mask,
       sum(CASE WHEN role = 'assistant' THEN size - length(head) ELSE 0 END)::BIGINT AS n_masked
FROM w GROUP BY conv_id, perspective, segment
""",
    "op5_prefix_groups": r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM pairs JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
    WHERE 100 * common >= 75 * (sx.n + sy.n - common)),
reach AS (
    SELECT doc_id, doc_id AS other FROM d
    UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN reach USING (doc_id) GROUP BY d.doc_id, n
""",
    "op8_benchmark_spans": r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS size,
           array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS run
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (
    SELECT doc_id, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS run
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, size, item_id FROM runs JOIN windows USING (size, run)),
words AS (
    SELECT doc_id, count(DISTINCT k) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hits) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items,
           sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
    FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op9_pareto_mix": r"""
WITH base AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           ((('0x' || substr(md5('0|' || coalesce(doc_id::VARCHAR, md5(text))), 1, 13))::BIGINT)::DOUBLE + 0.5)
               / 4503599627370496.0 AS u
    FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
weighed AS (
    SELECT *, source_size * 3 AS cap,
           1 + ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3) AS weight
    FROM sources),
levels AS (
    SELECT *,
           (sum(source_size) OVER () - (sum(cap) OVER f - cap))::DOUBLE
               / (sum(weight) OVER () - sum(weight) OVER f + weight)::DOUBLE AS level,
           row_number() OVER f AS place
    FROM weighed
    WINDOW f AS (ORDER BY cap::DOUBLE / weight::DOUBLE, source ASC NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
water AS (SELECT arg_min(level, place) AS water FROM levels WHERE cap >= weight * level),
targets AS (
    SELECT source, source_size, coalesce(least(cap::DOUBLE, weight * water), 0) AS target
    FROM levels, water),
odds AS (
    SELECT b.*, t.source_size, t.target,
           floor(CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END) AS whole,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS copies
    FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source),
ranked AS (
    SELECT *, copies - whole AS p,
           CASE WHEN copies > whole
                THEN u / (1 - u) / ((copies - whole) / (1 - (copies - whole))) END AS rank
    FROM odds),
summed AS (
    SELECT *,
           sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id NULLS LAST, size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
           sum(p * size) OVER (PARTITION BY source) AS quota
    FROM ranked)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN p > 0 AND upto - size / 2.0 < quota THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
""",
    "op10_warc_transactions": """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (
    SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS hex,
           min(page_id) OVER (PARTITION BY body) AS first_id
    FROM p),
d AS (
    SELECT *, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER,
               1)), '') AS payload_digest
    FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to,
       1::INTEGER AS n_requests
FROM d
""",
    "op11_sequence_trie": """
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id
               ORDER BY turn NULLS FIRST,
                        md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv_id, max(pos) AS own FROM t GROUP BY conv_id),
crc AS (  -- bit by bit over the decimal digits
    SELECT conv_id, own, (4294967295 - list_reduce(
        list_prepend(4294967295::BIGINT,
            list_transform(range(length(conv_id::VARCHAR)), lambda i: ascii(substr(conv_id::VARCHAR, i + 1, 1))::BIGINT)),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                 lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) % 6 AS h
    FROM sizes),
c AS (
    SELECT crc.conv_id, h, least(h, coalesce(b.own, 0)) AS m
    FROM crc LEFT JOIN sizes b ON b.conv_id = crc.conv_id - crc.conv_id % 100),
r AS (
    SELECT c.conv_id, t.pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos <= m
    UNION ALL
    SELECT c.conv_id, t.pos - h + m, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > h),
chained AS (  -- the list of all turns up to each one
    SELECT conv_id, pos AS depth, length(text) AS chars,
           list(length(role)::VARCHAR || ':' || role || text) OVER (
               PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path
    FROM r
    UNION ALL SELECT conv_id, 0, 0, [] FROM c),
p AS (
    SELECT conv_id, depth, chars, path, max(depth) OVER (PARTITION BY conv_id) AS n FROM chained),
keyed AS (
    SELECT *, min(conv_id) OVER (PARTITION BY path) AS node FROM p),
up AS (SELECT a.*, b.node AS parent FROM keyed a LEFT JOIN keyed b ON b.conv_id = a.conv_id AND b.depth = a.depth - 1),
nodes AS (
    SELECT node, depth, any_value(parent) AS parent, any_value(chars) AS chars, count(*) AS n_convs,
           coalesce(string_agg(CASE WHEN depth = n THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '') AS ends,
           (count(*) - 1) * any_value(chars) AS saved
    FROM up GROUP BY node, depth),
children AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node, depth)),
below AS (  -- every node counts for the nodes above it on its smallest member's path
    SELECT k.node, k.depth, sum(f.saved) AS saved, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves
    FROM full_nodes f JOIN keyed k ON k.conv_id = f.node AND k.depth <= f.depth GROUP BY ALL)
SELECT f.node AS conv_id, f.depth::BIGINT AS depth, f.parent AS parent_conv_id, f.n_convs::BIGINT AS n_convs,
       f.n_children::BIGINT AS n_children, below.n_leaves::BIGINT AS n_leaves, below.saved::BIGINT AS saved_tokens,
       sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN below USING (node, depth)
""",
    "op12_gram_variants": """
WITH RECURSIVE runs AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
marked AS (  -- CRC-32 bit by bit over the bytes of id and run
    SELECT run, n, CASE WHEN doc_id IS NULL THEN NULL ELSE 4294967295 - list_reduce(
        list_prepend(4294967295::BIGINT,
            list_transform(range(strlen(doc_id::VARCHAR || ':' || run)),
                           lambda i: ('0x' || substr(hex(encode(doc_id::VARCHAR || ':' || run)), 2 * i + 1, 2))::BIGINT)),
        lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                 lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))) END AS h
    FROM counted),
w AS (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
           sum(n)::BIGINT AS n
    FROM marked GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
holes AS (
    SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
near AS (  -- one letter replaced; one deleted; one inserted
    SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest
    WHERE a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM holes a JOIN w b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM holes a JOIN w b ON a.rest = b.word),
best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS top, min(encode(other)) FILTER (other_n = mx) AS other
    FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS mx FROM near) GROUP BY word),
forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * w.n THEN decode(other) END AS form,
           CASE WHEN top >= 2 * w.n THEN top END AS form_n
    FROM w LEFT JOIN best USING (word)),
chain AS (
    SELECT word, word AS top FROM forms
    UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON chain.top = forms.word WHERE forms.form IS NOT NULL),
roots AS (SELECT chain.word, chain.top AS root FROM chain JOIN forms ON chain.top = forms.word WHERE forms.form IS NULL)
SELECT word, n, n_near::BIGINT AS n_near, form, form_n::BIGINT AS form_n, root FROM forms JOIN roots USING (word)
""",
}
