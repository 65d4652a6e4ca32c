"""DuckDB SQL for the rows of the queries that SQL can express, written from the queries' definitions."""

from __future__ import annotations

#: CRC-32 of the ASCII digits of ``{0}``, bit by bit: a byte is mixed in, then eight shifts follow (marked by -1).
CRC32 = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}::VARCHAR, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b) ELSE xor(crc // 2, 3988292384::BIGINT * (crc % 2)) END))"""

URL_FILTERS = r"""
WITH rests AS (
    SELECT row_number() OVER () AS page, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM rests
), rules(of_host, of_path, says) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
    SELECT page, arg_max(of_host || of_path, length(of_host || of_path)) AS rule, arg_max(says, length(of_host || of_path)) AS says
    FROM parts JOIN rules ON (host = of_host OR ends_with(host, '.' || of_host)) AND starts_with(path, of_path) GROUP BY page
)
SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page)
"""

#: A turn takes its control strings (12 + 10), two line ends, and one backslash for each ``<|`` in role or text.
CHAT_FORMATTING = r"""
WITH said AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), rows AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place,
        coalesce(role, '') AS role, coalesce(text, '') AS text FROM said
), sized AS (
    SELECT *, 24 + length(replace(replace(role, '%', '%25'), chr(10), '%0A')) + length(text)
        + len(regexp_extract_all(role, '<\\*\|')) + len(regexp_extract_all(text, '<\\*\|')) AS size FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, sum(size)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

#: The terms of ``text``.
TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED_SEARCH = f"""
WITH docs AS (SELECT row_number() OVER () AS doc, doc_id, {TERMS} AS terms FROM documents WHERE text IS NOT NULL),
stats AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0),
items AS (SELECT row_number() OVER () AS item, item_id, {TERMS} AS terms FROM benchmark WHERE text IS NOT NULL),
wanted AS (SELECT item, term, count(*) AS times FROM (SELECT item, unnest(terms) AS term FROM items) GROUP BY item, term),
held AS (
    SELECT doc, doc_id, n, term, count(*) AS tf FROM (SELECT doc, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
    WHERE term IN (SELECT term FROM wanted) GROUP BY doc, doc_id, n, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM held, stats GROUP BY term, n_docs
), scored AS (
    SELECT item, doc, any_value(doc_id) AS doc_id,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM wanted JOIN held USING (term) JOIN weights USING (term), stats GROUP BY item, doc
), ranked AS (
    SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN items USING (item) WHERE rank <= 20
"""

PREFIX_TRIE = f"""
WITH own AS (
    SELECT conv_id, list(struct_pack(role := coalesce(role, ''), said := coalesce(text, '')) ORDER BY turn NULLS FIRST, role, text) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
    SELECT conv_id, turns, conv_id - conv_id % 100 AS head, {CRC32.format("conv_id")} % 6 AS h FROM own
), rebuilt AS (
    SELECT a.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, a.h), list_slice(a.turns, a.h + 1, len(a.turns))) AS turns
    FROM heads a LEFT JOIN own b ON b.conv_id = a.head
), prefixes AS (
    SELECT conv_id, depth, len(turns) = depth AS ends, sha256(list_slice(turns, 1, depth)::VARCHAR) AS node,
        CASE WHEN depth > 0 THEN sha256(list_slice(turns, 1, depth - 1)::VARCHAR) END AS above,
        CASE WHEN depth > 0 THEN length(turns[depth].said) ELSE 0 END AS size
    FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)
), nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, min(above) AS above, count(*) AS n_convs, min(size) AS size,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM prefixes GROUP BY node, depth
), kids AS (SELECT above, count(*) AS n FROM nodes GROUP BY above),
lines AS (  -- every node with itself and all nodes above it
    SELECT p.node AS top, n.node, (n.n_convs - 1) * n.size AS saved, (k.n IS NULL)::BIGINT AS leaf
    FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN kids k ON k.above = n.node
), subtrees AS (SELECT top, sum(saved)::BIGINT AS saved, sum(leaf)::BIGINT AS leaves FROM lines GROUP BY top)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, s.leaves AS n_leaves,
    s.saved AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s ON s.top = n.node LEFT JOIN nodes up ON up.node = n.above LEFT JOIN kids k ON k.above = n.node
"""
