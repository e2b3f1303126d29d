"""DuckDB SQL for the corpus queries that SQL can express."""

ORACLES: dict[str, str] = {
    # base32: the i-th digit is the five bits from bit 5 i on, cut from two hex digits
    "op3_zip_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
             r AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
        SELECT page_id, octet_length(encode(body)) AS payload_bytes,
               list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((((instr('0123456789abcdef', substr(hex, 1 + (5 * i) // 4, 1)) - 1) * 16
                        + greatest(instr('0123456789abcdef', substr(hex || '0', 2 + (5 * i) // 4, 1)) - 1, 0)) >> (3 - (5 * i) % 4)) & 31), 1)),
                   'string_agg', '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM r""",
    "op4_event_sourced_chat": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
                   UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(24 + length(url_encode(role)) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')))::BIGINT AS formatted_chars
        FROM c GROUP BY conv_id""",
    # the texts' pieces as word lists, every run of one to three words, then the textbook formulas
    "op13_trie_collocations": r"""
        WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
                       FROM documents),
             w AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM piece),
             gram AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) AS g
                      FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k),
             f AS (SELECT lang, k, g, count(*)::HUGEINT AS a FROM gram GROUP BY ALL),
             total AS (SELECT lang, sum(a)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
             cand AS (SELECT * FROM f WHERE k > 1 AND a >= 10),
             longer AS (SELECT lang, g[1:2] AS g, a FROM cand WHERE k = 3 UNION ALL SELECT lang, g[2:3], a FROM cand WHERE k = 3),
             kept AS (SELECT * FROM cand c WHERE NOT EXISTS
                        (SELECT 1 FROM longer x WHERE x.lang = c.lang AND x.g = c.g AND 100 * x.a >= 50 * c.a)),
             cut AS (SELECT c.lang, c.g, c.a, i, l.a AS l, r.a AS r, (1000000::HUGEINT * c.a * c.a) // (l.a * r.a) AS score
                     FROM (SELECT *, unnest(range(1, k)) AS i FROM kept) c
                     JOIN f l ON l.lang = c.lang AND l.g = c.g[1:i] JOIN f r ON r.lang = c.lang AND r.g = c.g[i + 1:]),
             best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, i) = 1),
             ranked AS (SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER
                          (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank FROM best)
        SELECT r.lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM ranked r JOIN total t ON t.lang = r.lang WHERE rank <= 2000""",
    # CRC-32 bit by bit; the edits by forward dynamic programming over whole scripts (cost, then audit), state by state
    "op11_block_repair": r"""
        WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                                      lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS t),
             k AS (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
             f AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                          xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
                                          lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 20 AS c
                   FROM k, crc),
             d AS (SELECT conv_id, turn, CASE c WHEN 4 THEN 'user' ELSE role END AS role,
                          CASE c WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                          unnest(range(CASE c WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM f WHERE c <> 0),
             o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                          rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, left(role, 1) AS p FROM d),
             m AS (SELECT *, CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                                  WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'c' ELSE '-' END AS fault,
                          lag(p) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
             n AS (SELECT DISTINCT conv_id FROM conversations),
             dp AS (SELECT conv_id, 0::BIGINT AS i, {'c': 0, 'a': '', 'r': ''} AS s0, {'c': 1000000, 'a': '', 'r': ''} AS s1,
                           {'c': 3, 'a': 'I', 'r': chr(10) || 'user:'} AS s2, {'c': 6, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'} AS s3 FROM n
                    UNION ALL
                    SELECT conv_id, i, u0, u1, v2, list_min([u3, {'c': v2.c + 3, 'a': v2.a || 'I', 'r': v2.r || chr(10) || 'assistant:'}])
                    FROM (SELECT *, list_min([u2, {'c': u0.c + 3, 'a': u0.a || 'I', 'r': u0.r || chr(10) || 'user:'},
                                                  {'c': u1.c + 3, 'a': u1.a || 'I', 'r': u1.r || chr(10) || 'user:'},
                                                  {'c': u3.c + 3, 'a': u3.a || 'I', 'r': u3.r || chr(10) || 'user:'}]) AS v2
                          FROM (SELECT dp.conv_id, m.i,
                                       {'c': s0.c + 4, 'a': s0.a || 'D', 'r': s0.r} AS u0,
                                       list_min([{'c': s1.c + 4, 'a': s1.a || 'D', 'r': s1.r},
                                                 {'c': s0.c + x.cut + x.ks, 'a': s0.a || 'K', 'r': s0.r || x.own}]) AS u1,
                                       list_min([{'c': s2.c + 4, 'a': s2.a || 'D', 'r': s2.r},
                                                 {'c': s0.c + x.cut + x.ku, 'a': s0.a || 'K', 'r': s0.r || x.own},
                                                 {'c': s1.c + x.cut + x.ku, 'a': s1.a || 'K', 'r': s1.r || x.own},
                                                 {'c': s3.c + x.cut + x.ku, 'a': s3.a || 'K', 'r': s3.r || x.own},
                                                 {'c': s0.c + x.cut + 3, 'a': s0.a || 'R', 'r': s0.r || chr(10) || 'user:' || text},
                                                 {'c': s1.c + x.cut + 3, 'a': s1.a || 'R', 'r': s1.r || chr(10) || 'user:' || text},
                                                 {'c': s3.c + x.cut + 3, 'a': s3.a || 'R', 'r': s3.r || chr(10) || 'user:' || text}]) AS u2,
                                       list_min([{'c': s3.c + 4, 'a': s3.a || 'D', 'r': s3.r},
                                                 {'c': s2.c + x.cut + x.ka, 'a': s2.a || 'K', 'r': s2.r || x.own},
                                                 {'c': s2.c + x.cut + 3, 'a': s2.a || 'R', 'r': s2.r || chr(10) || 'assistant:' || text}]) AS u3
                                FROM dp JOIN (SELECT *, {'cut': CASE fault WHEN 'c' THEN 3 WHEN '-' THEN 0 ELSE 1000000 END,
                                                         'ks': CASE p WHEN 's' THEN 0 ELSE 1000000 END, 'ku': CASE p WHEN 'u' THEN 0 ELSE 1000000 END,
                                                         'ka': CASE p WHEN 'a' THEN 0 ELSE 1000000 END, 'own': chr(10) || role || ':' || text} AS x FROM m) m
                                  ON m.conv_id IS NOT DISTINCT FROM dp.conv_id AND m.i = dp.i + 1))),
             best AS (SELECT conv_id, list_min([s0, s3]) AS b FROM dp QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
             g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
                          count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 'c') AS truncated,
                          count(*) FILTER (before IS NOT NULL AND before || p NOT IN ('su', 'ua', 'au')) AS illegal FROM m GROUP BY conv_id)
        SELECT n.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, b.c::BIGINT AS cost, b.a AS audit,
               sha256(substr(b.r, 2)) AS repaired_sha256
        FROM n JOIN best ON best.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM n.conv_id""",
}
