"""DuckDB forms of the registered queries of operators 11 to 13."""

from __future__ import annotations

#: ``crc(list of bytes)``: CRC-32 by its table of 256 entries, which the rule gives.
_CRC_TABLE = (
    "list_transform(range(256), lambda b: list_reduce(range(8), "
    "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b))"
)
_BYTES = (  # UTF-8 of digits, punctuation and Latin-1 letters
    "flatten(list_transform(string_split({}, ''), lambda ch: CASE WHEN unicode(ch) < 128 "
    "THEN [unicode(ch)::BIGINT] ELSE [195::BIGINT, ((unicode(ch) & 63) | 128)::BIGINT] END))"
)


def _crc(text: str) -> str:
    step = "lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce({_BYTES.format(text)}, {step}, 4294967295), 4294967295)"


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

SUPERMINHASH = f"""
    WITH RECURSIVE docs AS (
        SELECT doc_id, {_WORDS} AS w FROM documents
    ), sets AS (
        SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
            ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM docs
    ), items AS (
        SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
    ), links AS (
        SELECT x.doc_id AS a, y.doc_id AS b FROM items x JOIN items y ON x.item = y.item AND x.doc_id <> y.doc_id
        GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
    ), reach AS (
        SELECT doc_id, doc_id AS seen FROM sets UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.seen
    ), least AS (
        SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id
    )
    SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""

PERMUTERM = f"""
    WITH RECURSIVE crc_table AS MATERIALIZED (
        SELECT {_CRC_TABLE} AS t
    ), runs AS (
        SELECT doc_id, run, count(*) AS k FROM (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[a-zÀ-ÿ]+')) AS run FROM documents
        ) WHERE length(run) >= 7 GROUP BY doc_id, run
    ), hashed AS (
        SELECT run, k, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc_table
    ), words AS MATERIALIZED (
        SELECT word, sum(k)::BIGINT AS n FROM (
            SELECT k, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT)
                ELSE run END AS word FROM hashed
        ) WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
    ), cut AS (
        SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
        FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
    ), pairs AS (
        SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
        UNION SELECT cut.word, words.word FROM cut JOIN words ON cut.rest = words.word
        UNION SELECT words.word, cut.word FROM cut JOIN words ON cut.rest = words.word
    ), near AS (
        SELECT a AS word, count(*) AS n_near, max(n) AS top FROM pairs JOIN words ON words.word = b GROUP BY a
    ), best AS (
        SELECT near.word, n_near, top, min(b) AS form FROM near JOIN pairs ON a = near.word JOIN words ON words.word = b AND n = top
        GROUP BY near.word, n_near, top
    ), judged AS MATERIALIZED (
        SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * n THEN form END AS form,
            CASE WHEN top >= 10 * n THEN top END AS form_n
        FROM words LEFT JOIN best ON best.word = words.word
    ), follow AS (
        SELECT word, word AS root FROM judged
        UNION ALL SELECT follow.word, form FROM follow JOIN judged ON judged.word = root WHERE form IS NOT NULL
    )
    SELECT judged.*, root FROM judged JOIN follow USING (word)
    WHERE root IN (SELECT word FROM judged WHERE form IS NULL)
"""

PREFIX_TRIE = f"""
    WITH crc_table AS MATERIALIZED (
        SELECT {_CRC_TABLE} AS t
    ), turns AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
    ), convs AS (
        SELECT *, {_crc("conv_id::VARCHAR")} % 9 AS h
        FROM (SELECT conv_id, conv_id - conv_id % 5 AS base, max(pos) AS own FROM turns GROUP BY conv_id), crc_table
    ), heads AS (
        SELECT x.conv_id, x.base, x.h, least(x.h, coalesce(y.own, 0)) AS head FROM convs x LEFT JOIN convs y ON y.conv_id = x.base
    ), said AS (
        SELECT heads.conv_id, pos, role, text FROM heads JOIN turns ON turns.conv_id = base AND pos <= h
        UNION ALL SELECT heads.conv_id, pos - h + head, role, text FROM heads JOIN turns ON turns.conv_id = heads.conv_id AND pos > h
        UNION ALL SELECT conv_id, 0, NULL, NULL FROM heads
    ), members AS MATERIALIZED (
        SELECT conv_id, pos AS depth, coalesce(strlen(text), 0) AS bytes, pos = max(pos) OVER (PARTITION BY conv_id) AS ends,
            sha256(coalesce(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '')
                OVER (PARTITION BY conv_id ORDER BY pos), '')) AS node
        FROM said
    ), above AS (
        SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM members
    ), nodes AS MATERIALIZED (
        SELECT node, any_value(parent) AS parent, min(conv_id) AS conv_id, any_value(depth)::BIGINT AS depth, count(*) AS n_convs,
            (count(*) - 1) * any_value(bytes) AS saved,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
        FROM above GROUP BY node
    ), counted AS (
        SELECT nodes.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.parent = nodes.node) AS n_children
        FROM nodes LEFT JOIN nodes p ON p.node = nodes.parent
    ), under AS (
        SELECT DISTINCT x.node AS top, y.node FROM members x JOIN members y ON x.conv_id = y.conv_id AND y.depth >= x.depth
    ), sums AS (
        SELECT top, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
        FROM under JOIN counted USING (node) GROUP BY top
    )
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
    FROM counted JOIN sums ON top = counted.node
"""
