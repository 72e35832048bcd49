"""DuckDB SQL for the queries of which SQL can give the result."""

TOP_K_SQL = """
WITH vectors AS (
    SELECT row_number() OVER () AS uid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.uid uid, q.vec_id query_id, c.vec_id vec_id,
           CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) score
    FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND q.uid <> c.uid AND len(q.v) = len(c.v)
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS INTEGER) rank,
           vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# CRC-32 by half bytes over the hexadecimal text, low half first, with the table of 16 made
# from the polynomial.
_CRC_TABLE = """
list_transform(range(16), lambda n: list_reduce(list_prepend(n, range(4)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END))
"""


def _draws(shards: int) -> str:
    draw = (
        "-ln((CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':' || CAST(s AS VARCHAR)), 1, 13)"
        " AS BIGINT) + 0.5) / 4503599627370496)"
    )
    return f"list_transform(range({shards}), lambda s: {draw})"


SHARDING_SQL = f"""
WITH sized AS (
    SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) size,
           hex(encode(coalesce(text, ''))) digits
    FROM documents
), crc AS (SELECT {_CRC_TABLE} AS lookup
), summed AS (
    SELECT doc_id, size,
           CAST(xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
               range(2 * (size - 1)), lambda i: CAST(instr('123456789ABCDEF',
                   substr(digits, i + 2 - 2 * (i % 2), 1)) AS BIGINT))),
               lambda c, b: xor(lookup[xor(c % 16, b) + 1], c // 16))) AS BIGINT) text_crc32
    FROM sized, crc
), placed AS (
    SELECT *, list_position(d, list_min(d)) - 1 shard, list_position(g, list_min(g)) - 1 grown_shard,
           CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':' || CAST(text_crc32 AS VARCHAR)), 1, 8)
               AS BIGINT) % 1024 part
    FROM (SELECT *, {_draws(16)} d, {_draws(17)} g FROM summed)
)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) shard,
       row_number() OVER (PARTITION BY shard ORDER BY part, doc_id, text_crc32, size) - 1 AS slot,
       CAST(grown_shard AS INTEGER) grown_shard
FROM placed
"""

# Lines are compared as texts here, not by hashes.
LINE_RULES_SQL = r"""
WITH rows AS (
    SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host
    FROM documents
), worded AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM rows
), windows AS (
    SELECT uid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
    FROM (SELECT uid, w, unnest(range(1, len(w) - 1)) AS i FROM worded)
), repeated AS (
    SELECT uid, count(DISTINCT i + k) AS n
    FROM (SELECT uid, i, unnest(range(3)) AS k FROM windows JOIN (
        SELECT uid, win FROM windows GROUP BY uid, win HAVING count(*) > 1) USING (uid, win))
    GROUP BY uid
), cut AS (
    SELECT uid, host, text, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw
    FROM (SELECT uid, host, text, unnest(string_split(text, chr(10))) AS line FROM rows)
), lines AS (
    SELECT uid, host, text, line, len(lw) AS n, regexp_replace(translate(array_to_string(lw, ' '),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g') AS plain
    FROM cut WHERE len(lw) > 0
), doubled AS (
    SELECT uid, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY uid
), hosts AS (
    SELECT host, count(DISTINCT text) AS documents FROM rows GROUP BY host
), frequent AS (
    SELECT host, plain
    FROM (SELECT host, plain, count(DISTINCT text) AS n FROM lines GROUP BY host, plain HAVING n > 20)
    JOIN hosts USING (host) WHERE 1000 * n > documents
), removed AS (
    SELECT uid, sum(n) AS n FROM lines JOIN frequent USING (host, plain) GROUP BY uid
), found AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(m.n, 0) AS BIGINT) AS n_removed
    FROM worded LEFT JOIN doubled d USING (uid) LEFT JOIN repeated r USING (uid) LEFT JOIN removed m USING (uid)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM found
)
SELECT *, NOT base_failed AND n_words - n_removed >= 50 AND 100 * n_removed <= 50 * n_words AS kept
FROM judged
"""

SEARCH_SQL = r"""
WITH rows AS (
    SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), wanted AS (
    SELECT DISTINCT iid, item_id, term FROM (SELECT iid, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS iid, * FROM benchmark))
), totals AS (
    SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM rows WHERE len(terms) > 0
), counts AS (
    SELECT uid, doc_id, term, CAST(count(*) AS BIGINT) AS tf, CAST(any_value(n) AS BIGINT) AS n
    FROM (SELECT uid, doc_id, len(terms) AS n, unnest(terms) AS term FROM rows)
    WHERE term IN (SELECT term FROM wanted) GROUP BY uid, doc_id, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, totals GROUP BY term, n_docs
), scored AS (
    SELECT iid, item_id, uid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + 50 * n * n_docs // n_terms)))) AS BIGINT) AS score
    FROM wanted JOIN counts USING (term) JOIN weights USING (term), totals GROUP BY iid, item_id, uid, doc_id
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
        doc_id, score FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

HARD_NEGATIVES_SQL = """
WITH vectors AS (
    SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.uid AS anchor, a.vec_id AS anchor_id, c.uid AS other, c.vec_id AS other_id, a.label = c.label AS same,
        CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) AS BIGINT) AS score
    FROM vectors a JOIN vectors c ON a.vec_id % 100 = 0 AND a.uid <> c.uid AND len(a.v) = len(c.v)
), positives AS (
    SELECT anchor, anchor_id, other AS positive, other_id AS positive_id, score AS positive_score FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) AS place
        FROM scored WHERE same) WHERE place <= 5
), ranked AS (
    SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
    FROM positives p JOIN scored s ON p.anchor = s.anchor AND NOT s.same
        AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score
)
SELECT * FROM ranked WHERE rank <= 10
"""
