"""DuckDB SQL for the queries of this subpackage that SQL can express."""
from __future__ import annotations

from sparkpack.llm.quality import STOP_WORDS

_WORD = r"[^\x20\x09-\x0D]+"


def quality_sql() -> str:
    """Every metric and the threshold table, written out."""
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents
), split AS (
    SELECT rn, doc_id, t, regexp_extract_all(t, '{_WORD}') AS ws,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM docs
), place AS (
    SELECT rn, ws, unnest(range(1, len(ws) - 1)) AS p FROM split WHERE len(ws) >= 3
), win AS (
    SELECT rn, p, count(*) OVER (PARTITION BY rn, ws[p], ws[p + 1], ws[p + 2]) AS c FROM place
), covered AS (
    SELECT rn, count(DISTINCT p + k) AS n_repeat_words
    FROM win, (VALUES (0), (1), (2)) AS o(k) WHERE c > 1 GROUP BY rn
), m AS (
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
           CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
           len(list_filter(ws, lambda w: strlen(w) <= 8 AND lower(rtrim(w, '.,;:!?')) IN ({stop}))) AS n_stop,
           len(list_filter(ws, lambda w: ends_with(w, '!!'))) AS n_shout
    FROM split LEFT JOIN covered USING (rn)
), base AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 12.0 AND n_symbols / n_words <= CAST(0.1 AS DOUBLE)
       AND n_stop / n_words >= CAST(0.06 AS DOUBLE) AND n_dup_lines / n_lines <= CAST(0.3 AS DOUBLE)
       AND n_repeat_words / n_words <= 0.5 AND n_shout / n_words <= 0.5 AS kept
FROM base
"""


#: Every pair of one label; components as reachable sets.
VECTOR_DEDUP = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= CAST(0.98 AS DOUBLE)
), reach AS (
    SELECT DISTINCT a AS x, a AS y FROM pairs
    UNION
    SELECT r.x, p.b FROM reach r JOIN pairs p ON r.y = p.a
), links AS (
    SELECT a, count(*) AS n FROM pairs GROUP BY a
), least AS (
    SELECT x, min(y) AS c FROM reach GROUP BY x
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN links ON links.a = vec_id LEFT JOIN least ON least.x = vec_id
"""

#: Shingle sets compared over every shared shingle; components as reachable sets.
NEAR_DEDUP = rf"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS s
    FROM split
), sized AS (
    SELECT doc_id, s, CAST(len(s) AS BIGINT) AS n FROM sets
), element AS (
    SELECT doc_id, n, unnest(s) AS h FROM sized
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS shared
    FROM element a JOIN element b ON a.h = b.h AND a.doc_id <> b.doc_id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n
    GROUP BY ALL
), pairs AS (
    SELECT a, b FROM common WHERE 100 * shared >= 85 * (na + nb - shared)
), reach AS (
    SELECT DISTINCT a AS x, a AS y FROM pairs
    UNION
    SELECT r.x, p.b FROM reach r JOIN pairs p ON r.y = p.a
), least AS (
    SELECT x, min(y) AS c FROM reach GROUP BY x
)
SELECT doc_id, n AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept
FROM sized LEFT JOIN least ON least.x = doc_id
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Every pair of sources over every kept term.
SOURCE_AUDIT = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rn, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents
), word AS (
    SELECT rn, lang, source, unnest(regexp_extract_all({_LOWER.format("t")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS total FROM word GROUP BY ALL HAVING count(DISTINCT rn) >= 30
), cell AS (
    SELECT lang, source, term, count(*) AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), size AS (
    SELECT lang, source, coalesce(sum(n), 0) AS size FROM groups LEFT JOIN cell USING (lang, source) GROUP BY ALL
), v AS (
    SELECT lang, count(*) AS v, sum(total) AS total_all FROM kept GROUP BY lang
), p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (s.size + 5 * v.v) AS p,
           1 + (1000000000::HUGEINT * (k.total + 5)) // (v.total_all + 5 * v.v) AS q
    FROM groups g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang JOIN size s ON s.lang = g.lang AND s.source = g.source
    LEFT JOIN cell c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL
), part AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q
), numbered AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM part
)
SELECT * FROM numbered WHERE part = 'pair' OR rank <= 50
"""


def resampling_sql() -> str:
    """CRC-32 folded over the bits of every distinct word, then the whole order ranked."""
    words = f"regexp_extract_all({_LOWER.format('coalesce(text, chr(32))')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rn, doc_id, {words} AS ws FROM documents
), raw AS (
    SELECT w, rn FROM (SELECT rn, unnest(ws) AS w FROM docs)
), aim AS (
    SELECT unnest({words}) AS w FROM benchmark
), spelled AS (
    SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM raw UNION SELECT w FROM aim)
), bits AS (
    SELECT w, list_transform(range(0, 4 * len(x)), lambda i: (('0x' || substr(x, 2 * (i // 8) + 1, 2))::BIGINT >> (i % 8)) & 1) AS bits FROM spelled
), hashed AS (
    SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, bits), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295::BIGINT) % 10000 AS bucket
    FROM bits
), s AS (
    SELECT bucket, count(*) AS s FROM raw JOIN hashed USING (w) GROUP BY 1
), t AS (
    SELECT bucket, count(*) AS t FROM aim JOIN hashed USING (w) GROUP BY 1
), gain AS (
    SELECT bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM raw) + 10000))
        / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM aim) + 10000)))) AS BIGINT) AS gain
    FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
), mean AS (
    SELECT rn, count(*) AS n_features, sum(gain) AS total FROM raw JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY 1
), noise AS (
    SELECT rn, doc_id, ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM docs
), scored AS (
    SELECT rn, doc_id, coalesce(n_features, 0) AS n_features,
           coalesce(CASE WHEN total >= 0 THEN total // n_features ELSE -((-total + n_features - 1) // n_features) END, 0) AS weight,
           CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS gumbel
    FROM noise LEFT JOIN mean USING (rn)
), ranked AS (
    SELECT rn, row_number() OVER (ORDER BY weight + gumbel DESC, doc_id NULLS LAST, rn) AS rank FROM scored WHERE n_features >= 20
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(weight + gumbel AS BIGINT) AS score,
       CASE WHEN rank <= 10 * (SELECT count(*) FROM ranked) // 100 THEN CAST(rank AS BIGINT) END AS rank
FROM scored LEFT JOIN ranked USING (rn)
"""


#: CRC-32 folded over the bits of every text; seeded ranks within each source, then one order by fractional rank.
SHARDING = """
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), spelled AS (
    SELECT *, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda p: ('0x' || p)::BIGINT) AS bytes FROM d
), crc AS (
    SELECT doc_id, source, strlen(t) + 1 AS size, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(bytes,
               lambda b: [b & 1, (b >> 1) & 1, (b >> 2) & 1, (b >> 3) & 1, (b >> 4) & 1, (b >> 5) & 1, (b >> 6) & 1, (b >> 7) & 1]))),
               lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295::BIGINT) AS text_crc32,
           ('0x' || substr(md5('20240229:' || coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(source, '-')), 1, 15))::BIGINT AS h
    FROM spelled
), ranked AS (
    SELECT *, source IS NULL AS z, coalesce(source, '') AS s, row_number() OVER w - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM crc
    WINDOW w AS (PARTITION BY source ORDER BY h, doc_id NULLS FIRST)
), placed AS (
    SELECT *, row_number() OVER (ORDER BY (2 * r + 1) / (2.0::DOUBLE * n), z, s, h, doc_id NULLS FIRST) - 1 AS place, count(*) OVER () AS total FROM ranked
), sharded AS (
    SELECT *, least(place * 8 // total, 7) AS shard FROM placed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(place - (shard * total + 7) // 8 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM sharded
"""

ORACLES = {"op1_sharding": SHARDING, "op2_near_dedup": NEAR_DEDUP, "op5_vector_dedup": VECTOR_DEDUP, "op7_quality_rules": quality_sql(),
           "op11_source_audit": SOURCE_AUDIT, "op12_resampling": resampling_sql()}
