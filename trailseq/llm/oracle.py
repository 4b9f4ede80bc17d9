"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WARC = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
latest AS (SELECT payload, max(page_id) AS latest FROM p WHERE payload_bytes >= 1000 GROUP BY payload)
SELECT page_id, payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN latest IS NULL OR latest = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN latest <> page_id THEN latest END AS refers_to
FROM p LEFT JOIN latest ON p.payload = latest.payload
"""

LINES = """
WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents),
lines AS (
    SELECT doc_id, i - 1 AS pos, p[i] AS line, doc_id * 1000000 + i - 1 AS place
    FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM parts)),
firsts AS (SELECT line, min(place) AS first FROM lines WHERE length(line) > 0 GROUP BY line),
deletions AS (
    SELECT line, first, i, substring(line, 1, i - 1) || substring(line, i + 1) AS rest
    FROM (SELECT line, first, unnest(range(1, length(line) + 1)) AS i FROM firsts WHERE length(line) >= 12)),
replaced AS (SELECT rest, i, min(first) AS other FROM deletions GROUP BY rest, i),
longer AS (SELECT rest, min(first) AS other FROM deletions GROUP BY rest),
others AS (
    SELECT d.line, r.other FROM deletions d JOIN replaced r ON d.rest = r.rest AND d.i = r.i
    UNION ALL SELECT d.line, f.first FROM deletions d JOIN firsts f ON d.rest = f.line AND length(f.line) >= 12
    UNION ALL SELECT f.line, l.other FROM firsts f JOIN longer l ON f.line = l.rest AND length(f.line) >= 12
    UNION ALL SELECT line, first FROM firsts),
earliest AS (SELECT line, min(other) AS earliest FROM others GROUP BY line),
marked AS (
    SELECT doc_id, pos, l.line, coalesce(place > earliest, false) AS removed
    FROM lines l LEFT JOIN earliest e ON l.line = e.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT removed), '')) AS kept_sha256
FROM marked GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, NULL FROM documents WHERE text IS NULL
"""

REPEATS = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS p FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(p[i:i + 12], ' ') AS s
    FROM (SELECT doc_id, p, unnest(range(1, greatest(len(p) - 11, 1))) AS i FROM w)),
firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
gone AS (
    SELECT DISTINCT doc_id, i + k AS i
    FROM windows JOIN firsts USING (s) CROSS JOIN (SELECT unnest(range(13)) AS k) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(p) AS word, generate_subscripts(p, 1) AS i FROM w),
kept AS (
    SELECT doc_id, count(*) AS n_removed_not, string_agg(word, ' ' ORDER BY i) AS kept
    FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(p) AS n_words, len(p) - coalesce(n_removed_not, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

NEAR = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS p FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(p[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, p, unnest(range(1, greatest(len(p) - 3, 2))) AS i FROM w WHERE len(p) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN sizes sa ON sa.doc_id = a.doc_id JOIN sizes sb ON sb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, sa.n, sb.n HAVING 100 * count(*) >= 75 * (sa.n + sb.n - count(*))),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
LEFT JOIN sizes ON sizes.doc_id = d.doc_id
"""

NEGATIVES = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
           CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
    FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
 AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

AUDIT = r"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
flags AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 5 * length(d.text) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN d.doc_id > first THEN 'E' ELSE '' END AS failed
    FROM d JOIN firsts USING (text) LEFT JOIN flags USING (doc_id)),
counts AS (
    SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM f GROUP BY part, failed),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders),
walked AS (
    SELECT part, filter_order, step, filter_order[step] AS filter,
           CAST(sum(n) FILTER (hit = 0 OR hit > step) AS BIGINT) AS kept,
           CAST(sum(n) FILTER (hit = step) AS BIGINT) AS removed,
           CAST(sum(n) FILTER (hit < step AND contains(failed, filter_order[step])) AS BIGINT) AS redundant,
           CAST(sum(n) FILTER (failed = filter_order[step]) AS BIGINT) AS unique_fails,
           CAST(sum(good) FILTER (hit = step) AS BIGINT) AS good_lost,
           CAST(sum(toxic) FILTER (hit = step) AS BIGINT) AS toxic_lost
    FROM (SELECT counts.*, steps.*,
                 list_min([instr(filter_order, y) for y in regexp_extract_all(failed, '.')]) AS first_hit,
                 coalesce(first_hit, 0) AS hit
          FROM counts, steps)
    GROUP BY part, filter_order, step)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed,
       coalesce(redundant, 0) AS redundant, coalesce(unique_fails, 0) AS unique_fails,
       coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, filter), 0) AS BIGINT) AS shapley
FROM walked
"""

EDITED = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM documents),
pairs AS (
    SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next
    FROM texts)
SELECT doc_id, n_chars,
       sha256(substring(text, 1, n_chars - n_chars // 4) || substring(next, 1, n_chars // 4)) AS edited_sha256
FROM pairs
"""

# The fold is the CRC-32 of the id's digits; its table has 256 entries, made by 8 steps each.
UNIGRAMS = r"""
WITH RECURSIVE steps AS (
    SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS c, 0 AS k FROM (SELECT unnest(range(256)) AS i)
    UNION ALL
    SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc_table AS (SELECT i, c AS entry FROM steps WHERE k = 8),
digits AS (
    SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 1 AS place, CAST(4294967295 AS BIGINT) AS c
    FROM (SELECT DISTINCT doc_id FROM documents)
    UNION ALL
    SELECT doc_id, s, place + 1, xor(c >> 8, entry)
    FROM digits JOIN crc_table ON i = xor(c & 255, CAST(ascii(substring(s, place, 1)) AS BIGINT)) WHERE place <= length(s)),
folds AS (SELECT doc_id, xor(c, 4294967295) % 10 = 0 AS held_out FROM digits WHERE place = length(s) + 1),
texts AS (
    SELECT doc_id, held_out, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents JOIN folds USING (doc_id)),
occurrences AS (SELECT doc_id, held_out, unnest(words) AS word FROM texts),
counts AS (SELECT word, count(*) AS c FROM occurrences WHERE NOT held_out GROUP BY word),
ends AS (SELECT count(*) FILTER (NOT held_out) AS n_ends FROM texts),
sizes AS (
    SELECT n_ends, (SELECT coalesce(sum(c), 0) FROM counts) + n_ends AS n,
           (SELECT count(*) FROM counts) + CASE WHEN n_ends > 0 THEN 1 ELSE 0 END AS v FROM ends),
known AS (
    SELECT doc_id, count(c) AS n_known, sum(log10(coalesce(c, 0) + 0.1::DOUBLE)) AS log_sum
    FROM occurrences LEFT JOIN counts USING (word) GROUP BY doc_id)
SELECT doc_id, held_out, CAST(len(words) + 1 AS BIGINT) AS n_tokens,
       CAST(coalesce(n_known, 0) + CASE WHEN n_ends > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_known,
       CAST(n AS BIGINT) AS train_tokens,
       round(coalesce(log_sum, 0) + log10(n_ends + 0.1::DOUBLE) - (len(words) + 1) * log10(n + 0.1::DOUBLE * (v + 1)), 4)
           AS base_score
FROM texts CROSS JOIN sizes LEFT JOIN known USING (doc_id)
"""

ALL: dict[str, str] = {
    "op2_deletion_neighbourhood": LINES,
    "op4_content_addressed_warc": WARC,
    "op5_suffix_trees": REPEATS,
    "op10_bbit_minhash": NEAR,
    "op12_slot_negatives": NEGATIVES,
    "op13_potential_audit": AUDIT,
    "edited_text_digests": EDITED,
    "unigram_scores": UNIGRAMS,
}
