"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]'), lambda w: w <> '')"

LINE_DEDUP = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
    FROM lines
), repeated AS (
    SELECT line_key, max(doc_id) AS holder FROM keyed WHERE length(line_key) >= 20
    GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT keyed.*, coalesce(doc_id < holder, false) AS gone FROM keyed LEFT JOIN repeated USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

QUALITY = rf"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS words FROM documents
), windows AS (
    SELECT doc_id, i, (words[i], words[i + 1], words[i + 2]) AS w
    FROM docs, unnest(range(1, len(words) - 1)) AS r(i)
), repeated AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, unnest([0, 1, 2]) AS s(k) GROUP BY doc_id
), lines AS (
    SELECT doc_id, line, pos, {WORDS.format("line")} AS words,
        len(regexp_extract_all(line, '[#*$%&|<>]')) AS symbols
    FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
            generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM docs
    )
), marked AS (
    SELECT *, len(words) AS n, length(list_aggregate(words, 'string_agg', '')) AS chars,
        len(list_filter(words, lambda w: regexp_matches(w, '^[|>/\-]$'))) AS marks
    FROM lines
), judged AS (
    SELECT *, n > 0 AND (
        symbols > 0.1::DOUBLE * chars
        OR marks >= 3 AND marks * 4 >= n
        OR n >= 40 AND NOT regexp_matches(line, '[.!?,;:]')
            AND NOT regexp_matches(regexp_replace(line, '[\x00-\x7F]+', '', 'g'), '\p{{Po}}')
        OR n <= 25 AND regexp_matches(line, '(?i)(all rights reserved|cookie policy|privacy policy|terms of use|terms of service|enable javascript|javascript is disabled|click here|skip to content|sign up for|log in to|subscribe to our)')
    ) AS fails
    FROM marked
), cleaned AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (fails) AS n_lines_removed,
        coalesce(sum(chars), 0)::BIGINT AS word_chars,
        coalesce(sum(chars) FILTER (fails), 0)::BIGINT AS lost_chars,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT fails), '')) AS cleaned_sha256,
        count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines
    FROM judged GROUP BY doc_id
), figures AS (
    SELECT doc_id, len(words)::BIGINT AS n_words, word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words, n_lines, n_lines_removed, lost_chars, cleaned_sha256
    FROM docs JOIN cleaned USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost_chars <= 0.5::DOUBLE * word_chars AS kept
FROM figures
"""

MIX = """
WITH counts AS (
    SELECT source, count(*) AS n, sum(count(*)) OVER () AS total, count(*) OVER () AS sources
    FROM documents GROUP BY source
), rates AS (
    SELECT source, total::DOUBLE / (sources::DOUBLE * n) AS rate FROM counts
), steps AS (
    SELECT source, k, sum(CASE WHEN k = 0 THEN -rate ELSE ln(rate) - ln(k::DOUBLE) END)
        OVER (PARTITION BY source ORDER BY k) AS logp
    FROM rates, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 24)::BIGINT + 1)) AS r(k)
), distribution AS (
    SELECT source, k, sum(exp(logp)) OVER (PARTITION BY source ORDER BY k) AS cdf FROM steps
), drawn AS (
    SELECT *, ('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT
        / 4503599627370496::DOUBLE AS u
    FROM documents
), counted AS (
    SELECT drawn.doc_id, text, lang, drawn.source, n_chars,
        (SELECT count(*) FROM distribution AS d WHERE d.source IS NOT DISTINCT FROM drawn.source AND d.cdf <= u)
        AS n_copies
    FROM drawn
)
SELECT doc_id, text, lang, source, n_chars, n_copies::INTEGER AS n_copies, r.copy::INTEGER AS copy,
    ('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, '') || '|' || r.copy), 1, 13))::BIGINT AS shuffle_key
FROM counted, unnest(range(1, n_copies + 1)) AS r(copy)
"""

CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), formatted AS (
    SELECT *, CASE role WHEN 'user' THEN '[INST]  [/INST]' WHEN 'system' THEN '[SYS]  [/SYS]'
            WHEN 'assistant' THEN '[ANS]  </s>'
            ELSE '[ROLE:' || replace(replace(role, '%', '%25'), ']', '%5D') || ']  [/ROLE]' END
        || regexp_replace(text, '([<\[])(\\*/?(?:s>|INST\]|SYS\]|ANS\]|ROLE[:\]]))', '\1\\\2', 'g') AS shown
    FROM turns
), chats AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role, '|' ORDER BY turn NULLS FIRST, role, text) AS roles,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')
            AS learned,
        (3 + sum(length(shown)))::BIGINT AS formatted_chars
    FROM formatted GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars,
    sha256(learned) AS loss_sha256, formatted_chars,
    CASE roles WHEN 'user|assistant' THEN 'prompt_response'
        WHEN 'system|user|assistant' THEN 'system_prompt_response' ELSE 'messages' END AS layout
FROM chats
"""

COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]'), lambda w: w <> '') AS ws FROM pieces
), f1 AS (
    SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(ws) AS x FROM split) GROUP BY ALL
), f2 AS (
    SELECT lang, p[1] AS x, p[2] AS y, count(*) AS f
    FROM (SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: [ws[i], ws[i + 1]])) AS p FROM split)
    GROUP BY ALL
), f3 AS (
    SELECT lang, p[1] AS x, p[2] AS y, p[3] AS z, count(*) AS f
    FROM (SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: [ws[i], ws[i + 1], ws[i + 2]])) AS p
          FROM split)
    GROUP BY ALL HAVING count(*) >= 10
), longer AS (
    SELECT lang, x, y, max(f) AS f
    FROM (SELECT lang, x, y, f FROM f3 UNION ALL SELECT lang, y, z, f FROM f3) GROUP BY ALL
), two AS (
    SELECT p.lang, p.x || ' ' || p.y AS phrase, p.f AS a, l.f AS l, r.f AS r,
        1000000::HUGEINT * p.f * p.f // (l.f::HUGEINT * r.f) AS score
    FROM f2 p JOIN f1 l ON (l.lang, l.x) = (p.lang, p.x) JOIN f1 r ON (r.lang, r.x) = (p.lang, p.y)
    LEFT JOIN longer m ON (m.lang, m.x, m.y) = (p.lang, p.x, p.y)
    WHERE p.f >= 10 AND coalesce(100 * m.f < 50 * p.f, true)
), cuts AS (
    SELECT p.lang, p.x || ' ' || p.y || ' ' || p.z AS phrase, p.f AS a,
        1000000::HUGEINT * p.f * p.f // (l1.f::HUGEINT * r1.f) AS s1, l1.f AS l1, r1.f AS r1,
        1000000::HUGEINT * p.f * p.f // (l2.f::HUGEINT * r2.f) AS s2, l2.f AS l2, r2.f AS r2
    FROM f3 p JOIN f1 l1 ON (l1.lang, l1.x) = (p.lang, p.x)
    JOIN f2 r1 ON (r1.lang, r1.x, r1.y) = (p.lang, p.y, p.z)
    JOIN f2 l2 ON (l2.lang, l2.x, l2.y) = (p.lang, p.x, p.y)
    JOIN f1 r2 ON (r2.lang, r2.x) = (p.lang, p.z)
), scored AS (
    SELECT * FROM two
    UNION ALL
    SELECT lang, phrase, a, if(s2 < s1, l2, l1), if(s2 < s1, r2, r1), least(s1, s2) FROM cuts
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM ranked JOIN (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang) USING (lang) WHERE rank <= 2000
"""

# DuckDB has no CRC-32: its table of 256 is worked out bit by bit, and a run's bytes go through it.
SPELLING = r"""
WITH RECURSIVE bits(b, c, k) AS (
    SELECT range::BIGINT, range::BIGINT, 0 FROM range(256)
    UNION ALL
    SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
    SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8
), runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{7,}')) AS run
    FROM documents
), hashed AS (
    SELECT run, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
            range(1, 2 * octet_length(encode(id || ':' || run)), 2),
            lambda i: ('0x' || hex(encode(id || ':' || run))[i : i + 1])::BIGINT)),
        lambda v, byte: xor(v >> 8, t[(xor(v, byte) & 255) + 1])), 4294967295) AS h
    FROM runs, crc
), words AS (
    SELECT word, count(*) AS n
    FROM (SELECT CASE WHEN h % 31 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word
          FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), shortened AS (
    SELECT DISTINCT word, n, i, word[: i - 1] AS before, word[i + 1 :] AS behind
    FROM words, unnest(range(1, length(word) + 1)) AS r(i)
), near AS (
    SELECT a.word, b.word AS other, b.n FROM shortened a JOIN shortened b
        ON a.i = b.i AND a.before = b.before AND a.behind = b.behind AND a.word <> b.word
    UNION
    SELECT s.word, w.word, w.n FROM shortened s JOIN words w ON s.before || s.behind = w.word
    UNION
    SELECT w.word, s.word, s.n FROM shortened s JOIN words w ON s.before || s.behind = w.word
), best AS (
    SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS most FROM near GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, if(most >= 10 * w.n, other, NULL) AS form,
        if(most >= 10 * w.n, most, NULL) AS form_n
    FROM words w LEFT JOIN best USING (word)
), chains(word, root, d) AS (
    SELECT word, form, 1 FROM formed WHERE form IS NOT NULL
    UNION ALL
    SELECT c.word, f.form, d + 1 FROM chains c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT word, form, coalesce(last, word) AS root, n, n_near, form_n
FROM formed LEFT JOIN (SELECT word, arg_max(root, d) AS last FROM chains GROUP BY word) USING (word)
"""
