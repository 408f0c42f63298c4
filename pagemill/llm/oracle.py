"""SQL counterparts of the registered queries, for DuckDB, where SQL can express them.

The others rest on hashes with a seed, keyed permutations, fitted models or a tokenizer;
their tests hold them against plain versions.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {
    # A plain reading of the test pages, whose only main text is an article element.
    "op2_html": r"""
        SELECT page_id, url, text, length(text) AS n_chars
        FROM (SELECT page_id, url,
                     trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                         regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|\z)', 1),
                         '<[^>]*>', ' ', 'g'), '&lt;?', '<', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'),
                         '\s+', ' ', 'g')) AS text
              FROM pages)""",
    "op3_chat": """
        WITH rows_ AS (
            SELECT DISTINCT conv_id, coalesce(turn, -9223372036854775808) AS turn,
                   coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL),
        steps AS (
            SELECT conv_id, turn, count(*) AS n,
                   string_agg(role || chr(1) || text, chr(2) ORDER BY role, text) AS step,
                   string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                              ORDER BY role, text) AS piece
            FROM rows_ GROUP BY conv_id, turn),
        prefixes AS (
            SELECT conv_id, turn, row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS length,
                   string_agg(CAST(turn AS VARCHAR) || chr(3) || step, chr(4)) OVER w AS prefix
            FROM steps WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
        kept AS (
            SELECT min(conv_id) AS conv_id, count(*) AS copies
            FROM prefixes
            WHERE k = length AND prefix NOT IN (SELECT prefix FROM prefixes WHERE k < length)
            GROUP BY prefix)
        SELECT conv_id, copies, CAST(floor(turn / 256) AS BIGINT) AS segment,
               CAST(sum(n) AS BIGINT) AS n_turns, string_agg(piece, '' ORDER BY turn) AS rendered
        FROM kept JOIN steps USING (conv_id) GROUP BY conv_id, copies, segment""",
    "op10_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        WHERE rank <= 10""",
    "op11_fim": r"""
        WITH drawn AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h,
                   regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines
            FROM documents),
        cut AS (
            SELECT doc_id, text, lines, len(lines) AS n,
                   CAST('0x' || h[1:8] AS BIGINT) % (len(lines) + 1) AS a,
                   CAST('0x' || h[9:16] AS BIGINT) % (len(lines) + 1) AS b,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
                        WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM drawn),
        parts AS (
            SELECT *, array_to_string(lines[1:least(a, b)], '') AS p,
                   array_to_string(lines[least(a, b) + 1:greatest(a, b)], '') AS m,
                   array_to_string(lines[greatest(a, b) + 1:], '') AS s
            FROM cut)
        SELECT doc_id, n, form,
               CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                                ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts""",
    # The checksum of a feature is worked out byte by byte, once for each distinct feature.
    "op12_importance": r"""
        WITH steps AS (
            SELECT list(c ORDER BY n) AS t
            FROM (SELECT n, list_reduce(list_concat([n], range(8)),
                                        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
                  FROM (SELECT unnest(range(256)) AS n))),
        words AS (
            SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
        listed AS (
            SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM words),
        found AS (
            SELECT side, id, unnest(w) AS f FROM listed
            UNION ALL
            SELECT side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM listed),
        hashed AS (
            SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(0, octet_length(encode(f))),
                                  lambda i: CAST('0x' || hex(encode(f))[2 * i + 1:2 * i + 2] AS BIGINT))),
                              lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket
            FROM (SELECT DISTINCT f FROM found), steps),
        placed AS (SELECT side, id, bucket FROM found JOIN hashed USING (f)),
        counts AS (
            SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM placed GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM counts) + 10000.0::DOUBLE)
                                 / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM counts) + 10000.0::DOUBLE)))) AS gain
            FROM counts),
        weights AS (
            SELECT id, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
            FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
        scored AS (
            SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + CAST(floor(-1000.0::DOUBLE * ln(-ln((CAST('0x' || sha256('7:' || id)[1:8] AS BIGINT) + 0.5::DOUBLE)
                                                                  / 4294967296.0::DOUBLE))) AS BIGINT) AS score
            FROM listed LEFT JOIN weights USING (id) WHERE side = 'd'),
        ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
            FROM scored WHERE n_words >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= (25 * n) // 100 THEN place END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)""",
}
