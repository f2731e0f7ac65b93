"""DuckDB SQL for the queries of this subpackage that SQL can express."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(" + LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, coalesce({WORDS.format('text')}, []) AS w FROM documents),
b AS (SELECT item_id, {WORDS.format('text')} AS w FROM benchmark),
bg AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
             FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bg),
dg AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns WHERE len(w) >= n)),
h AS (SELECT doc_id, i, n, item_id FROM dg JOIN bg USING (n, g)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS s
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(s, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)"""

CHAT = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
      FROM t),
c AS (SELECT conv_id, count(*) AS n,
             string_agg(coalesce('=' || role, '-') || chr(31) || coalesce('=' || text, '-') || chr(30), '' ORDER BY i) AS whole
      FROM p GROUP BY conv_id),
stay AS (SELECT min(conv_id) AS conv_id, whole, n FROM c
         WHERE NOT EXISTS (SELECT 1 FROM c l WHERE l.n > c.n AND starts_with(l.whole, c.whole)) GROUP BY whole, n)
SELECT conv_id, CAST((i - 1) // 1000 AS BIGINT) AS segment, n AS n_turns,
       string_agg('<|im_start|>' || replace(coalesce(role, ''), '<|', '< |') || chr(10)
                  || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY i) AS text
FROM stay JOIN p USING (conv_id) GROUP BY conv_id, segment, n"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce({WORDS.format('text')}, []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS g
      FROM (SELECT doc_id, w, least(5, len(w)) AS n, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i
            FROM d WHERE len(w) > 0)),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
e AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
      JOIN z p ON p.doc_id = x.doc_id JOIN z q ON q.doc_id = y.doc_id
      GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 5 * count(*) >= 4 * (p.n + q.n - count(*))),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a),
l AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT d.doc_id, least(d.doc_id, coalesce(m.b, d.doc_id)) AS class_id, CAST(coalesce(l.n, 0) AS BIGINT) AS n_links
FROM d LEFT JOIN m ON m.a = d.doc_id LEFT JOIN l ON l.a = d.doc_id"""

_base32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v[{k // 4 + 1}] >> {15 - 5 * (k % 4)}) & 31 AS INTEGER) + 1, 1)"
    for k in range(32))
_parts = ", ".join(f"CAST('0x' || substr(sha1(h), {5 * k + 1}, 5) AS BIGINT)" for k in range(8))
WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, h, [{_parts}] AS v, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, {_base32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM x"""

AUDIT = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
f AS (SELECT part, coalesce(g.good, false) AS good, coalesce(g.toxic, false) AS toxic,
        CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
        + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS INT)
        + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(doc_id > first AS INT) AS mask
      FROM w LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
                        FROM labels GROUP BY 1) g USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY 1, 2),
o AS (SELECT '' AS o, 0 AS used UNION ALL
      SELECT o || substr('ABCDE', k + 1, 1), used + (1 << k) FROM o, range(5) r(k) WHERE (used >> k) & 1 = 0),
s AS (SELECT o.o, CAST(k AS INT) AS step, 1 << (ascii(o.o[k]) - 65) AS bit,
             coalesce(list_sum(list_transform(range(1, k), lambda j: 1 << (ascii(o.o[j]) - 65))), 0)::BIGINT AS before
      FROM o, range(1, 6) r(k) WHERE used = 31),
x AS (SELECT part, o, step, bit,
        sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, s GROUP BY 1, 2, 3, 4)
SELECT part, o AS filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM x"""

SUBSTRINGS = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
r AS (SELECT doc_id, i FROM g QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1),
p AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM r),
h AS (SELECT doc_id, list(p) AS gone, count(*) AS n FROM p GROUP BY 1),
k AS (SELECT doc_id, string_agg(x, ' ' ORDER BY k) AS kept FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM d)
      WHERE (doc_id, k) NOT IN (SELECT doc_id, p FROM p) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)"""

ORACLE_SQL = {
    "op1_decontaminate": DECONTAMINATE,
    "op7_chat_format": CHAT,
    "op9_jaccard_join": JACCARD,
    "op10_warc": WARC,
    "op11_filter_audit": AUDIT,
    "op12_substring_dedup": SUBSTRINGS,
}
