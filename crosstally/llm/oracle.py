"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

ORACLE = {
    "op4_digest_index": r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM n
WINDOW g AS (PARTITION BY text_sha256)
""",
    "op5_topk": """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS terms
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([a * c.terms[i] FOR a, i IN q.terms]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op7_mixing": """
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source
),
walk AS (
  SELECT *, sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER before, 0) AS words_left,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS w_left
  FROM s
  WINDOW before AS (ORDER BY 6 * source_size // w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
capped AS (SELECT *, words_left * w > 3 * source_size * w_left AS full_up FROM walk),
rest AS (
  SELECT sum(source_size) - coalesce(3 * sum(source_size) FILTER (full_up), 0) AS words,
         sum(w) FILTER (NOT full_up) AS ws
  FROM capped
),
planned AS (
  SELECT source, source_size,
         CASE WHEN full_up THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(words * w AS DOUBLE) / ws END AS target,
         CASE WHEN source_size = 0 THEN 0 WHEN full_up THEN 3072
              ELSE (2 * 1024 * words * w + ws * source_size) // (2 * ws * source_size) END AS quota
  FROM capped CROSS JOIN rest
),
placed AS (
  SELECT d.*, p.source_size, p.target, p.quota,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source
),
cut AS (
  SELECT *, least(1023, 1024 * (2 * earlier + size) // greatest(2 * source_size, 1)) AS block FROM placed
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * ((block < quota)::INT + (block + 1024 < quota)::INT + (block + 2048 < quota)::INT) AS BIGINT) AS taken
FROM cut
""",
    "op2_tool_calls": """
WITH RECURSIVE t AS (
  SELECT conv_id, turn, role, text, len(string_split(coalesce(text, ''), ' ')) AS n,
         CAST(to_json(coalesce(text, '')) AS VARCHAR) AS quoted, length(coalesce(text, '')) % 4 AS kind
  FROM conversations
),
calls AS (
  SELECT conv_id, 'call-' || turn AS call_id, turn AS position, n, quoted, kind, turn,
         CASE WHEN kind = 0 THEN 'search' WHEN kind = 1 THEN 'lookup' WHEN kind = 2 THEN 'translate'
              WHEN n % 3 = 0 THEN 'forget' ELSE 'convert' END AS name,
         [x FOR x IN list_distinct(['call-' || (turn // 2), 'call-' || (turn // 3)]) IF x <> 'call-' || turn] AS deps
  FROM t WHERE role = 'assistant'
),
results AS (
  SELECT conv_id, 'call-' || (turn - 1) AS call_id, turn AS position, text AS content
  FROM t WHERE role = 'user' AND turn > 0
  UNION ALL
  SELECT conv_id, coalesce(role, 'turn') || '-' || turn, turn, text
  FROM t WHERE role IS NULL OR role NOT IN ('assistant', 'user') OR role = 'user' AND turn <= 0
),
edges AS (
  SELECT e.conv_id, e.call_id, e.dep
  FROM (SELECT conv_id, call_id, unnest(deps) AS dep FROM calls) e
  WHERE EXISTS (SELECT 1 FROM calls k WHERE k.conv_id = e.conv_id AND k.call_id = e.dep)
),
paths AS (
  SELECT conv_id, call_id, 0 AS level FROM calls
  UNION
  SELECT e.conv_id, e.call_id, p.level + 1 FROM edges e JOIN paths p ON p.conv_id = e.conv_id AND p.call_id = e.dep
),
placed AS (SELECT conv_id, call_id, CAST(max(level) AS INTEGER) AS level FROM paths GROUP BY ALL),
judged AS (
  SELECT c.*, p.level, r.content, r.call_id IS NOT NULL AS answered,
    CASE name
      WHEN 'search' THEN '{"limit":' || CASE WHEN n % 7 = 0 THEN '"many"' ELSE CAST(n % 20 AS VARCHAR) END
                         || ',"query":' || quoted || '}'
      WHEN 'lookup' THEN '{"fields":["b","a"]' || CASE WHEN n % 5 = 0 THEN '' ELSE ',"id":' || turn END
                         || ',"note":' || quoted || '}'
      WHEN 'translate' THEN '{"formal":true,"target":"de","text":' || quoted
                            || CASE WHEN n % 6 = 0 THEN ',"tone":"dry"' ELSE '' END || '}'
      ELSE CASE WHEN n % 2 = 0 THEN CAST(to_json('{"note": ' || quoted || ', "value": ') AS VARCHAR)
                ELSE '{"note":' || quoted || ',"value":2.5}' END END AS arguments,
    CASE WHEN name = 'search' AND n % 7 = 0 THEN 'limit is not integer'
         WHEN name = 'lookup' AND n % 5 = 0 THEN 'missing id'
         WHEN name = 'translate' AND n % 6 = 0 THEN 'unexpected tone'
         WHEN name = 'convert' AND n % 2 = 0 THEN 'not JSON'
         WHEN name = 'forget' THEN 'unknown tool' ELSE '' END AS errors
  FROM calls c
  JOIN placed p ON p.conv_id = c.conv_id AND p.call_id = c.call_id
  LEFT JOIN results r ON r.conv_id = c.conv_id AND r.call_id = c.call_id
),
records AS (
  SELECT conv_id, call_id, level, position, name, errors, arguments, deps, content,
         CASE WHEN errors <> '' THEN 'invalid' WHEN NOT answered THEN 'pending' ELSE 'ok' END AS status
  FROM judged
  UNION ALL
  SELECT r.conv_id, r.call_id, NULL, r.position, NULL, '', 'null', [], r.content, 'orphan'
  FROM results r
  WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = r.conv_id AND c.call_id = r.call_id)
)
SELECT conv_id, call_id, level, position, name, status, errors, CAST(0 AS BIGINT) AS repeats,
       '{"arguments":' || arguments || ',"call_id":"' || call_id || '","depends_on":'
       || CAST(to_json(list_sort(deps)) AS VARCHAR) || ',"name":' || coalesce('"' || name || '"', 'null') || ',"result":'
       || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || ',"status":"' || status || '"}' AS json
FROM records
""",
    "op11_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
listed AS (SELECT lang, row_number() OVER () AS piece_no, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, piece_no, unnest(w) AS one, unnest(range(1, len(w) + 1)) AS i FROM listed),
runs AS (
  SELECT lang, one, lead(one, 1) OVER p AS two, lead(one, 2) OVER p AS three FROM words
  WINDOW p AS (PARTITION BY piece_no ORDER BY i)
),
grams AS (
  SELECT lang, 1 AS k, one AS phrase FROM runs
  UNION ALL SELECT lang, 2, one || ' ' || two FROM runs WHERE two IS NOT NULL
  UNION ALL SELECT lang, 3, one || ' ' || two || ' ' || three FROM runs WHERE three IS NOT NULL
),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.*, cut, array_to_string(w[1 : cut], ' ') AS left_part, array_to_string(w[cut + 1 :], ' ') AS right_part
  FROM c JOIN (VALUES (1), (2)) AS x(cut) ON cut < k
),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, cut, fl.f AS l, fr.f AS r,
         CAST(1000000 * a::HUGEINT * a // (fl.f::HUGEINT * fr.f) AS BIGINT) AS score
  FROM cuts JOIN f fl ON fl.lang = cuts.lang AND fl.phrase = left_part AND fl.k = cut
            JOIN f fr ON fr.lang = cuts.lang AND fr.phrase = right_part AND fr.k = cuts.k - cut
),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
),
around AS (
  SELECT lang, phrase, max(a) AS a
  FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE k = 3) GROUP BY ALL
),
kept AS (
  SELECT x.* FROM weakest x LEFT JOIN around o ON o.lang = x.lang AND o.phrase = x.phrase
  WHERE o.a IS NULL OR 100 * o.a < 50 * x.a
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
""",
    "op12_cover_codes": r"""
WITH v AS (
  SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS t
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
),
step AS (SELECT max(len(t)) // 16 AS d FROM v),
parts AS (
  SELECT vec_id, p, t[p * d + 1 : (p + 1) * d] AS x FROM v CROSS JOIN step CROSS JOIN range(16) AS r(p)
),
book0 AS (
  SELECT p, dense_rank() OVER (ORDER BY vec_id) - 1 AS e, x FROM parts
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 64)
),
near0 AS (
  SELECT vec_id, q.p, q.x, arg_min(b.e, list_sum([(i - b.x[n]) * (i - b.x[n]) FOR i, n IN q.x])::HUGEINT * 64 + b.e) AS e
  FROM parts q JOIN book0 b ON b.p = q.p GROUP BY ALL
),
mean0 AS (
  SELECT p, e, list(m ORDER BY place) AS x FROM (
    SELECT p, e, place, CAST(floor(sum(x[place]) / count(*)) AS BIGINT) AS m
    FROM near0 CROSS JOIN step CROSS JOIN range(1, 129) AS r(place) WHERE place <= d GROUP BY p, e, place
  ) GROUP BY p, e
),
book1 AS (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book0 b LEFT JOIN mean0 m ON m.p = b.p AND m.e = b.e),
near1 AS (
  SELECT vec_id, q.p, q.x, arg_min(b.e, list_sum([(i - b.x[n]) * (i - b.x[n]) FOR i, n IN q.x])::HUGEINT * 64 + b.e) AS e
  FROM parts q JOIN book1 b ON b.p = q.p GROUP BY ALL
),
mean1 AS (
  SELECT p, e, list(m ORDER BY place) AS x FROM (
    SELECT p, e, place, CAST(floor(sum(x[place]) / count(*)) AS BIGINT) AS m
    FROM near1 CROSS JOIN step CROSS JOIN range(1, 129) AS r(place) WHERE place <= d GROUP BY p, e, place
  ) GROUP BY p, e
),
book2 AS (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book1 b LEFT JOIN mean1 m ON m.p = b.p AND m.e = b.e),
gaps AS (
  SELECT vec_id, q.p, b.e, list_sum([(i - b.x[n]) * (i - b.x[n]) FOR i, n IN q.x]) AS gap
  FROM parts q JOIN book2 b ON b.p = q.p
),
coded AS (
  SELECT vec_id, p, arg_min(e, gap::HUGEINT * 64 + e) AS e, min(gap) AS gap FROM gaps GROUP BY ALL
),
codes AS (
  SELECT vec_id, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, CAST(sum(gap) AS BIGINT) AS error
  FROM coded GROUP BY vec_id
),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT codes.vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN v ON v.vec_id = codes.vec_id CROSS JOIN digest
""",
    "op13_decontaminate": r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS words
  FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)
),
places AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
stretches AS (
  SELECT doc_id, i, size, string_agg(word, ' ') OVER run AS words, count(*) OVER run AS held
  FROM places CROSS JOIN (SELECT DISTINCT size FROM windows)
  WINDOW run AS (PARTITION BY doc_id, size ORDER BY i ROWS BETWEEN CURRENT ROW AND size - 1 FOLLOWING)
),
found AS (SELECT doc_id, i, item_id, windows.size FROM stretches JOIN windows USING (size, words) WHERE held = size),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits ON hits.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
""",
}
