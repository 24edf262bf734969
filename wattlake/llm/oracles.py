"""DuckDB SQL for the corpus queries, written from the contracts."""

# The shares by rounds: sources above their cap are clamped, the rest is dealt anew.
MIX = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS draw
  FROM documents
), src AS (
  SELECT source, sum(size)::DOUBLE AS n,
         [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM sized GROUP BY source
), rounds AS (
  SELECT 0 AS r, source, n, w, false AS clamped FROM src
  UNION ALL
  SELECT r + 1, source, n, w,
         clamped OR 3 * n * sum(CASE WHEN clamped THEN 0 ELSE w END) OVER ()
                    <= w * (sum(n) OVER () - sum(CASE WHEN clamped THEN 3 * n ELSE 0 END) OVER ())
  FROM rounds WHERE r < 60
), filled AS (
  SELECT source, n, CASE WHEN clamped THEN 3 * n ELSE
           w * (sum(n) OVER () - sum(CASE WHEN clamped THEN 3 * n ELSE 0 END) OVER ())
             / sum(CASE WHEN clamped THEN 0 ELSE w END) OVER () END AS target
  FROM rounds WHERE r = 60
), parts AS (
  SELECT source, n, target, CASE WHEN n = 0 THEN 0 ELSE floor(target / n) END AS whole FROM filled
), placed AS (
  SELECT doc_id, source, size, draw, sum(size) OVER (PARTITION BY source ORDER BY draw) AS until,
         sum(size) OVER (PARTITION BY source, draw) AS together
  FROM sized
)
SELECT doc_id, size, n::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN 2 * until - together <= 2 * (target - whole * n) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed JOIN parts ON placed.source IS NOT DISTINCT FROM parts.source
"""

# Every window of 20 words against its earliest place.
PASSAGES = r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w FROM documents
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 19], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w)
), repeated AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS n FROM windows
  ) WHERE n > 1
), covered AS (
  SELECT doc_id, list(DISTINCT j) AS c FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM repeated) GROUP BY doc_id
)
SELECT w.doc_id, len(w) AS n_words, coalesce(len(c), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN c IS NULL THEN w
         ELSE list_transform(list_sort(list_where(range(1, len(w) + 1), list_transform(range(1, len(w) + 1), lambda j: NOT list_contains(c, j)))),
                             lambda j: w[j]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id
"""

# All pairs of different sets that share a shingle, counted exactly.
NEAR = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []::VARCHAR[]
                      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))))
                 END AS s
  FROM w
), classes AS (
  SELECT min(doc_id) AS id, len(s) AS n, s FROM sets WHERE len(s) > 0 GROUP BY s
), grams AS (
  SELECT id, n, unnest(s) AS g FROM classes
), pairs AS (
  SELECT a.id AS x, b.id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.id <> b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT id AS x, id AS y FROM classes
  UNION
  SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x
), comp AS (
  SELECT x, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, len(sets.s) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM sets LEFT JOIN classes ON sets.s = classes.s AND len(sets.s) > 0 LEFT JOIN comp ON comp.x = classes.id
"""

# Containment by counting, item by item; an item under five words is one gram of its length.
LEAKS = r"""
WITH texts AS (
  SELECT true AS doc, doc_id AS id, text FROM documents UNION ALL SELECT false, item_id, text FROM benchmark
), w AS (
  SELECT doc, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x20\x09-\x0D]+') AS w
  FROM texts
), lengths AS (
  SELECT DISTINCT least(len(w), 5) AS k FROM w WHERE NOT doc AND len(w) > 0
), grams AS (
  SELECT doc, id, k, unnest(list_distinct(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))) AS g
  FROM w JOIN lengths ON len(w) >= k AND (doc OR k = least(len(w), 5))
), items AS (
  SELECT id, k, g, count(*) OVER (PARTITION BY id) AS n FROM grams WHERE NOT doc
)
SELECT d.id AS doc_id, i.id AS item_id, n AS n_item, count(*) AS n_shared, count(*)::DOUBLE / n AS containment
FROM grams d JOIN items i ON d.doc AND d.k = i.k AND d.g = i.g
GROUP BY d.id, i.id, n HAVING 100 * count(*) >= 75 * n
"""

# DuckDB has no checksum of this kind: the usual table by its rule, then byte by byte.
SHARDS = r"""
WITH steps AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce([i] || range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
    FROM (SELECT unnest(range(256))::BIGINT AS i))
), raw AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (
  SELECT doc_id, (len(h) / 2)::BIGINT + 16 AS size,
         xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT),
             lambda a, b: xor(a >> 8, crc[xor(a & 255, b) + 1])), 4294967295) AS text_crc32
  FROM raw, steps
), cut AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS LAST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS until,
         sum(size) OVER () AS total
  FROM sized
), placed AS (
  SELECT *, least(39, ((2 * until - size) * 40) // (2 * total))::INT AS shard FROM cut
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS LAST, text_crc32, size) - 1 AS slot,
       NULL::INT AS grown_shard
FROM placed
"""

COPIES = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n
"""

# Every order is walked through: a document goes at the first filter that it fails.
AUDIT = r"""
WITH marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN texts.doc_id > min(texts.doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM texts LEFT JOIN marks ON texts.doc_id = marks.doc_id
), kinds AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.l NOT IN (b.l, c.l, d.l, e.l) AND b.l NOT IN (c.l, d.l, e.l) AND c.l NOT IN (d.l, e.l) AND d.l <> e.l
), walked AS (
  SELECT part, o, fails, n, good, toxic,
         coalesce(list_min(list_transform(regexp_extract_all(fails, '.'), lambda f: instr(o, f))), 6) AS gone
  FROM kinds, orders
), steps AS (
  SELECT part, o AS filter_order, s AS step,
         sum(CASE WHEN gone > s THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN gone = s THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone < s AND contains(fails, o[s]) THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = o[s] THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN gone = s THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN gone = s THEN toxic ELSE 0 END) AS toxic_lost
  FROM walked, (SELECT unnest(range(1, 6)) AS s) GROUP BY part, o, s
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, sum(removed) OVER (PARTITION BY part, filter_order[step])::BIGINT AS shapley
FROM steps
"""

# Near words by their texts with one letter masked or left out; the checksum byte by byte.
VARIANTS = r"""
WITH RECURSIVE crcs AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce([i] || range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
    FROM (SELECT unnest(range(256))::BIGINT AS i))
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents) WHERE length(run) >= 7 GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(doc_id || ':' || run)), '..'),
                                                                        lambda x: ('0x' || x)::BIGINT),
                                 lambda a, b: xor(a >> 8, crc[xor(a & 255, b) + 1])), 4294967295) AS h
  FROM runs, crcs
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word,
         sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING sum(n) >= 2 AND length(word) >= 7
), holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION
  SELECT x.word, x.n, y.word, y.n FROM holes x JOIN words y ON x.a || x.b = y.word
  UNION
  SELECT y.word, y.n, x.word, x.n FROM holes x JOIN words y ON x.a || x.b = y.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM near GROUP BY word
), chosen AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * words.n THEN form END AS form,
         CASE WHEN form_n >= 10 * words.n THEN form_n END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word
), ways AS (
  SELECT word, word AS at, form AS onward FROM chosen
  UNION ALL
  SELECT ways.word, chosen.word, chosen.form FROM ways JOIN chosen ON ways.onward = chosen.word
)
SELECT chosen.word, form, ways.at AS root, n, n_near, form_n
FROM chosen JOIN ways ON chosen.word = ways.word AND ways.onward IS NULL
"""

ORACLES: dict[str, str] = {
    "op1_mix_sources": MIX,
    "op2_repeated_passages": PASSAGES,
    "op3_near_duplicates": NEAR,
    "op5_benchmark_leaks": LEAKS,
    "op7_byte_shards": SHARDS,
    "op10_content_sort": COPIES,
    "op12_filter_audit": AUDIT,
    "op13_spelling_variants": VARIANTS,
}
