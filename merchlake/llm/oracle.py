"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op7_quality_rules"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS id, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS body FROM documents
), split AS (
    SELECT *, list_filter(string_split_regex(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(body, chr(10)), lambda x: regexp_replace(x, '[\x20\x09-\x0D]', '', 'g') <> '') AS lines
    FROM d
), places AS (
    SELECT id, words, unnest(range(1, len(words) - 3)) AS pos FROM split
), windows AS (
    SELECT id, pos, array_to_string(list_slice(words, pos, pos + 4), ' ') AS win FROM places
), repeated AS (
    SELECT id, pos FROM windows
    QUALIFY count(*) OVER (PARTITION BY id, win) > 1
), covered AS (
    SELECT id, count(DISTINCT word) AS n FROM (SELECT id, unnest(range(pos, pos + 5)) AS word FROM repeated) GROUP BY id
), texts AS (
    SELECT host, body, lines, count(*) AS copies FROM split GROUP BY host, body, lines
), each_line AS (
    SELECT host, body, copies, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
    FROM (SELECT host, body, copies, unnest(lines) AS line FROM texts)
), per_text AS (
    SELECT host, body, line, any_value(copies) AS copies, count(*) * (1 + len(line) - len(replace(line, ' ', ''))) AS words
    FROM each_line GROUP BY host, body, line
), frequent AS (
    SELECT host, line FROM per_text GROUP BY host, line HAVING sum(copies) > 20
), removed AS (
    SELECT host, body, sum(words)::BIGINT AS n FROM per_text JOIN frequent USING (host, line) GROUP BY host, body
), counted AS (
    SELECT s.doc_id, len(s.words)::BIGINT AS n_words,
        len(regexp_replace(s.body, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (len(s.body) - len(regexp_replace(s.body, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(s.lines) - len(list_distinct(s.lines)))::BIGINT AS n_dup_lines,
        coalesce(c.n, 0)::BIGINT AS n_repeat_words, coalesce(r.n, 0)::BIGINT AS n_removed_words
    FROM split s LEFT JOIN covered c USING (id) LEFT JOIN removed r ON r.host = s.host AND r.body = s.body
), judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        n_words - n_removed_words AS remaining FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND remaining >= 10 AND 100 * remaining >= 30 * n_words AS kept, n_removed_words
FROM judged
"""

ORACLE["op12_ranked_lexical_search"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), q AS (
    SELECT row_number() OVER () AS item, item_id, list_distinct(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms
    FROM benchmark
), totals AS (
    SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS all_terms FROM d WHERE len(terms) > 0
), tf AS (
    SELECT id, doc_id, n, term, count(*) AS tf FROM (SELECT id, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
    GROUP BY id, doc_id, n, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM tf, totals GROUP BY term, n_docs
), impacts AS (
    SELECT id, doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // all_terms)) AS impact
    FROM tf, totals
), scored AS (
    SELECT item, item_id, id, doc_id, sum(w * impact)::BIGINT AS score
    FROM (SELECT item, item_id, unnest(terms) AS term FROM q) JOIN weights USING (term) JOIN impacts USING (term)
    GROUP BY item, item_id, id, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
