"""SQL answers of the numbered queries, for DuckDB."""

_LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {}

ORACLES["op4_line_dedup"] = f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS n FROM cut),
keyed AS (SELECT *, translate(trim(line, {_BLANKS}), {_LOW}) AS line_key FROM lines),
firsts AS (SELECT line_key, min(doc_id) AS first_doc FROM keyed WHERE length(line_key) >= 10
           GROUP BY line_key HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT k.*, f.first_doc IS NOT NULL AND k.doc_id > f.first_doc AS gone
           FROM keyed k LEFT JOIN firsts f USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLES["op7_exact_dedup"] = f"""
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), {_LOW}) AS body FROM documents),
groups AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM low GROUP BY body)
SELECT l.doc_id, g.keep_id, g.group_size, l.doc_id = g.keep_id AS kept, sha256(l.body) AS text_sha256
FROM low l JOIN groups g USING (body)
"""

ORACLES["op10_substring_dedup"] = f"""
WITH cut AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS body
            FROM cut, LATERAL (SELECT unnest(range(1, len(words) - 18)) AS i) WHERE len(words) >= 20),
firsts AS (SELECT body, min((doc_id, i)) AS place FROM windows GROUP BY body HAVING count(*) > 1),
gone AS (SELECT DISTINCT w.doc_id, w.i + d AS i
         FROM windows w JOIN firsts f USING (body), (SELECT unnest(range(0, 20)) AS d)
         WHERE (w.doc_id, w.i) > f.place),
words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM cut),
judged AS (SELECT w.*, g.i IS NOT NULL AS removed FROM words w LEFT JOIN gone g USING (doc_id, i)),
kept AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE removed) AS n_removed,
                string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT removed) AS body
         FROM judged GROUP BY doc_id)
SELECT c.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.body, '')) AS kept_sha256
FROM cut c LEFT JOIN kept k USING (doc_id)
"""

ORACLES["op8_ngram_jaccard_join"] = f"""
WITH RECURSIVE cut AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOW}), '{_WORD}') AS words FROM documents),
sets AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
         ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END)) AS shingles FROM cut),
classes AS (SELECT shingles, min(doc_id) AS class_id, count(*) AS n_copies, len(shingles) AS n FROM sets GROUP BY shingles),
flat AS (SELECT class_id, n, unnest(shingles) AS shingle FROM classes),
links AS (SELECT a.class_id AS a, b.class_id AS b FROM flat a JOIN flat b USING (shingle) WHERE a.class_id <> b.class_id
          GROUP BY a.class_id, b.class_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
degree AS (SELECT a AS class_id, count(*) AS n_links FROM links GROUP BY a),
reach(class_id, root) AS (SELECT class_id, class_id FROM classes
                          UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.class_id),
groups AS (SELECT class_id, min(root) AS group_id FROM reach GROUP BY class_id)
SELECT s.doc_id, g.group_id AS class_id, c.class_id AS set_id, c.n_copies, coalesce(d.n_links, 0) AS n_links, s.doc_id = g.group_id AS kept
FROM sets s JOIN classes c USING (shingles) JOIN groups g USING (class_id) LEFT JOIN degree d USING (class_id)
"""

ORACLES["op11_topk_search"] = """
WITH vectors AS (SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS c FROM embeddings
                 WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.c, v.c)::BIGINT AS score
           FROM vectors q JOIN vectors v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

ORACLES["op12_fill_in_middle"] = """
WITH cut AS (SELECT doc_id, coalesce(text, '') AS body, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS sha FROM documents),
drawn AS (SELECT *, ('0x' || sha[1:8])::BIGINT % (n + 1) AS a, ('0x' || sha[9:16])::BIGINT % (n + 1) AS b,
                 ('0x' || sha[17:24])::BIGINT % 100 AS h3, ('0x' || sha[25:32])::BIGINT % 100 AS h4 FROM cut),
formed AS (SELECT *, least(a, b) AS first, greatest(a, b) AS last,
                  CASE WHEN n = 0 OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 >= 90 THEN 'plain'
                       WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, substring(body, 1, first) AS p, substring(body, first + 1, last - first) AS m, substring(body, last + 1) AS s FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN first END AS prefix_chars, CASE WHEN form <> 'plain' THEN last - first END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'spm' THEN concat('<S>', s, '<P>', p, '<M>', m) ELSE concat('<P>', p, '<S>', s, '<M>', m) END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM parts
"""

#: CRC-32 of a feature's bytes, read from its hex digits two at a time.
_CRC = """
WITH RECURSIVE steps(i, k, c) AS (
    SELECT i, 0, i FROM range(256) t(i)
    UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM steps WHERE k = 8)
"""

ORACLES["op13_importance_resampling"] = _CRC + f""",
texts AS (SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS body FROM documents
          UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark),
cut AS (SELECT side, id, regexp_extract_all(translate(body, {_LOW}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM texts),
flat AS (SELECT side, id, unnest(list_concat(words, [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))])) AS feature FROM cut),
counts AS (SELECT side, id, feature, count(*) AS n FROM flat GROUP BY ALL),
hashed AS (SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || h[2 * i + 1:2 * i + 2])::BIGINT FOR i IN range(len(h) // 2)]),
                  lambda c, b: xor(c >> 8, crcs[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
           FROM (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM counts)), crc_table),
bucketed AS (SELECT side, id, bucket, sum(n)::BIGINT AS n FROM counts JOIN hashed USING (feature) GROUP BY ALL),
totals AS (SELECT coalesce(sum(n) FILTER (WHERE side = 'd'), 0)::BIGINT AS s, coalesce(sum(n) FILTER (WHERE side = 'b'), 0)::BIGINT AS t FROM bucketed),
both_sides AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0)::BIGINT AS s, coalesce(sum(n) FILTER (WHERE side = 'b'), 0)::BIGINT AS t
               FROM bucketed GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln(((b.t + 1) * (a.s + 10000))::DOUBLE / ((b.s + 1) * (a.t + 10000))::DOUBLE))::BIGINT AS gain FROM both_sides b, totals a),
weights AS (SELECT id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
            FROM bucketed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
drawn AS (SELECT c.id AS doc_id, len(c.words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                 ('0x' || sha256('7:' || c.id)[1:8])::BIGINT AS h
          FROM cut c LEFT JOIN weights w ON w.id = c.id WHERE c.side = 'd'),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM drawn),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_words >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= 25 * (SELECT count(*) FROM ranked) // 100 THEN rank END AS rank
FROM scored s LEFT JOIN ranked r USING (doc_id)
"""
