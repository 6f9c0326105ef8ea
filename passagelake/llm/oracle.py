"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

LLM_ORACLE: dict[str, str] = {
    "op1_exact_dedup": """
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body
            FROM documents
        ), k AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY body) AS group_size
            FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM k
    """,
    "op6_url_filter": """
        WITH p AS (
            SELECT page_id,
                   CASE WHEN contains(url, '://') THEN regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1) ELSE '' END AS h,
                   CASE WHEN contains(url, '://') THEN regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
            FROM pages
        ), q AS (
            SELECT page_id, path,
                   translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
            FROM p
        ), r(rh, rp, v) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                   ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ), m AS (
            SELECT q.*, rh || rp AS rule, v,
                   row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
            FROM q LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
        )
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
    """,
    "op9_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), o AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS original FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> original THEN original END AS refers_to
        FROM o
    """,
    "op3_substring_dedup": """
        WITH d AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), p AS (
            SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d
        ), k AS (
            SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS seq FROM p
        ), g AS (
            SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY seq) AS least FROM k) WHERE least < doc_id
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g
        ), words AS (
            SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS line, count(*) AS n
            FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op4_decontaminate": """
        WITH dw AS (
            SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w
            FROM documents WHERE text IS NOT NULL
        ), iw AS (
            SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w
            FROM benchmark WHERE text IS NOT NULL
        ), ds AS (
            SELECT doc_id, w, p, array_to_string(w[p + 1:p + 5], ' ') AS sh
            FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS p FROM dw WHERE len(w) > 0)
        ), ish AS (
            SELECT item_id, n, q, array_to_string(w[q + 1:q + 5], ' ') AS sh
            FROM (SELECT item_id, w, len(w) AS n, unnest(range(greatest(len(w) - 4, 1))) AS q FROM iw WHERE len(w) > 0)
        ), laid AS (
            SELECT DISTINCT doc_id, greatest(p - q, 0) AS start,
                   w[greatest(p - q, 0) + 1:greatest(p - q, 0) + n + least(p - q, 0)] AS win
            FROM ds JOIN ish USING (sh)
        ), numbered AS (
            SELECT *, row_number() OVER () AS k FROM laid
        ), ws AS (
            SELECT k, array_to_string(win[p + 1:p + 5], ' ') AS sh, count(*) AS c
            FROM (SELECT k, win, unnest(range(greatest(len(win) - 4, 1))) AS p FROM numbered) GROUP BY ALL
        ), ic AS (
            SELECT item_id, sh, count(*) AS c FROM ish GROUP BY ALL
        ), wt AS (
            SELECT k, sum(c) AS total FROM ws GROUP BY k
        ), it AS (
            SELECT item_id, sum(c) AS total FROM ic GROUP BY item_id
        ), common AS (
            SELECT k, item_id, sum(least(ws.c, ic.c)) AS common FROM ws JOIN ic USING (sh) GROUP BY ALL
        ), scored AS (
            SELECT doc_id, item_id, start, len(win) AS n_words, common / (wt.total + it.total - common) AS similarity
            FROM common JOIN wt USING (k) JOIN it USING (item_id) JOIN numbered USING (k)
        ), best AS (
            SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start, n_words) AS r
            FROM scored WHERE similarity >= 0.8
        )
        SELECT doc_id, item_id, start, n_words, similarity::DOUBLE AS similarity FROM best WHERE r = 1
    """,
    "op10_mixing": """
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
        ), s AS (
            SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
            FROM d GROUP BY source
        ), w AS (
            SELECT *, ([5, 2, 1])[number % 3 + 1]::DOUBLE AS weight, (3 * source_size)::DOUBLE AS top FROM s
        ), x AS (
            SELECT *, ((sum(source_size) OVER ())::DOUBLE - coalesce(sum(top) OVER (
                       ORDER BY top / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(weight) OVER (ORDER BY top / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
            FROM w
        ), t AS (
            SELECT source, number, source_size, CASE WHEN top <= share * weight THEN top
                   ELSE weight * max(CASE WHEN top > share * weight THEN share END) OVER () END AS target
            FROM x
        ), b AS (
            SELECT greatest(1, least(1024, floor(min(target) FILTER (target > 0) / 512)))::BIGINT AS block,
                   sum(source_size) AS total FROM t
        ), c AS (
            SELECT number, round(sum(target) OVER (ORDER BY number) / sum(target) OVER () * 2147483648)::BIGINT AS high FROM t
        ), r AS (
            SELECT number, high, lag(high, 1, 0) OVER (ORDER BY number) AS low FROM c
        ), points AS (
            SELECT (i * 1327217885) % 2147483648 AS point
            FROM (SELECT unnest(range(round_even(total / block, 0)::BIGINT)) AS i FROM b)
        ), slots AS (
            SELECT number, count(*) AS n FROM points JOIN r ON low <= point AND point < high GROUP BY number
        ), placed AS (
            SELECT doc_id, size, source_size, target, coalesce(n, 0) * block AS words,
                   coalesce(sum(size) OVER (PARTITION BY t.number ORDER BY md5(doc_id::VARCHAR), doc_id, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN slots USING (number), b
        )
        SELECT doc_id, size, source_size, target, sum(CASE WHEN e * source_size <= target
                   THEN greatest(0, least(e * source_size + start + size, words) - (e * source_size + start)) ELSE 0 END)::BIGINT AS taken
        FROM placed, range(3) AS rounds(e) GROUP BY ALL
    """,
    "op11_conversation_repair": """
        WITH RECURSIVE filled AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   list_transform(string_split(concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')), ''), lambda x: ascii(x)::BIGINT) AS bytes
            FROM conversations
        ), kinds AS (
            SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295, bytes), lambda c, b: list_reduce(
                       list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS kind
            FROM filled
        ), damaged AS (
            SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM kinds, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS copies
        ), ordered AS (
            SELECT *, left(role, 1) AS initial, md5(text) AS digest, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS said
            FROM damaged
        ), faults AS (
            SELECT *, row_number() OVER sequence AS i, lag(initial) OVER sequence || initial NOT IN ('su', 'ua', 'au') AS illegal,
                   CASE WHEN body = '' THEN 'blank' WHEN said THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
            FROM ordered WINDOW sequence AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest, said)
        ), counted AS (
            SELECT o.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (illegal) AS illegal, count(i) AS n
            FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
            GROUP BY o.conv_id
        ), places AS (
            SELECT * FROM (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)) AS t(place, wanted, follows)
        ), best AS (
            SELECT conv_id, 0::BIGINT AS i, place, cost::BIGINT AS cost, edits, lines
            FROM counted, (VALUES (0, 0, '', ''), (2, 2, 'I', 'user:'), (3, 4, 'II', 'user:' || chr(10) || 'assistant:')) AS t(place, cost, edits, lines)
            UNION ALL
            SELECT conv_id, i, place, least_.cost, least_.edits, least_.lines FROM (
                SELECT conv_id, i, place, min(struct_pack(cost := cost, edits := edits, lines := lines)) AS least_ FROM (
                    SELECT conv_id, i, a.place, cost + 2 * n AS cost, edits || repeat('I', n) AS edits,
                           lines || CASE WHEN n > 0 THEN CASE WHEN lines = '' THEN '' ELSE chr(10) END || b.wanted || ':' ELSE '' END
                           || CASE WHEN n > 1 THEN chr(10) || c.wanted || ':' ELSE '' END AS lines
                    FROM (
                        SELECT b.conv_id, f.i, e.edit, b.cost + CASE e.edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
                                   + CASE WHEN e.edit <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END AS cost,
                               b.edits || e.edit AS edits,
                               CASE WHEN e.edit = 'D' THEN b.place WHEN e.edit = 'K' AND initial = 's' THEN 1 ELSE p.follows END AS after,
                               CASE WHEN e.edit = 'D' THEN lines ELSE lines || CASE WHEN lines = '' THEN '' ELSE chr(10) END
                                   || CASE e.edit WHEN 'K' THEN role ELSE p.wanted END || ':' || text END AS lines
                        FROM best b JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1 JOIN places p ON p.place = b.place,
                             (VALUES ('D'), ('K'), ('R')) AS e(edit)
                        WHERE e.edit = 'D' OR fault NOT IN ('blank', 'duplicate') AND (e.edit = 'R'
                              OR initial = left(p.wanted, 1) OR initial = 's' AND b.place = 0)
                    ) edited JOIN places b ON b.place = after JOIN places c ON c.place = b.follows, range(3) AS inserted(n),
                         LATERAL (SELECT CASE n WHEN 0 THEN after WHEN 1 THEN b.follows ELSE c.follows END AS place) a
                ) GROUP BY conv_id, i, place
            )
        )
        SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, x.cost, x.edits AS audit, sha256(x.lines) AS repaired_sha256
        FROM counted c JOIN (
            SELECT conv_id, i, min(struct_pack(cost := cost, edits := edits, lines := lines)) AS x FROM best WHERE place IN (0, 3) GROUP BY conv_id, i
        ) b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = c.n
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS same, list_inner_product(a.q, v.q)::BIGINT AS score
            FROM v AS a JOIN v ON len(a.q) = len(v.q) WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT * FROM scored WHERE same AND id <> anchor_id
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        )
        SELECT p.anchor_id, p.id AS positive_id,
               (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id))::INTEGER AS rank,
               n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
         AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
        QUALIFY rank <= 10
    """,
}
