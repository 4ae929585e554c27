"""SQL that states the results that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER copies AS keep_id,
               count(*) OVER copies AS group_size,
               doc_id = max(doc_id) OVER copies AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW copies AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_filter_audit": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
        ), words AS (
            SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts
        ), failed AS (
            SELECT doc_id, part,
                   len(w) < 200 AS a,
                   100 * list_unique(w) < 50 * len(w) AS b,
                   100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) AS c,
                   regexp_matches(text, '[#$%&*|]') AS d,
                   coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
            FROM words
        ), said AS (
            SELECT doc_id, coalesce(max(quality) = 1, false) AS good, coalesce(max(toxic) = 1, false) AS toxic
            FROM labels GROUP BY doc_id
        ), masks AS (
            SELECT part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int AS mask, count(*) AS n,
                   count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
            FROM failed LEFT JOIN said USING (doc_id) GROUP BY ALL
        ), letters AS (
            SELECT unnest([1, 2, 4, 8, 16]) AS bit
        ), orders AS (
            SELECT [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
            FROM letters p, letters q, letters r, letters s, letters t
            WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31
              AND (p.bit | q.bit | r.bit | s.bit | t.bit) = 31
        ), steps AS (
            SELECT array_to_string(list_transform(bits, lambda x: chr(65 + log2(x)::int)), '') AS filter_order,
                   step::int AS step, bits[step] AS bit, list_sum(bits[1:step - 1])::int AS before
            FROM orders, generate_series(1, 5) AS g(step)
        ), counted AS (
            SELECT part, filter_order, step, bit,
                   sum(n) FILTER (WHERE mask & (bit | coalesce(before, 0)) = 0) AS kept,
                   sum(n) FILTER (WHERE mask & bit > 0 AND mask & coalesce(before, 0) = 0) AS removed,
                   sum(n) FILTER (WHERE mask & bit > 0 AND mask & coalesce(before, 0) > 0) AS redundant,
                   sum(n) FILTER (WHERE mask = bit) AS unique_fails,
                   sum(good) FILTER (WHERE mask & bit > 0 AND mask & coalesce(before, 0) = 0) AS good_lost,
                   sum(toxic) FILTER (WHERE mask & bit > 0 AND mask & coalesce(before, 0) = 0) AS toxic_lost
            FROM masks, steps GROUP BY ALL
        )
        SELECT part, filter_order, step,
               coalesce(kept, 0)::bigint AS kept, coalesce(removed, 0)::bigint AS removed,
               coalesce(redundant, 0)::bigint AS redundant, coalesce(unique_fails, 0)::bigint AS unique_fails,
               coalesce(good_lost, 0)::bigint AS good_lost, coalesce(toxic_lost, 0)::bigint AS toxic_lost,
               coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::bigint AS shapley
        FROM counted
    """,
    "op12_item_search": r"""
        WITH own AS (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), sums AS (
            SELECT count(*) AS all_docs, sum(len(terms))::bigint AS all_terms FROM own WHERE len(terms) > 0
        ), shapes AS (
            SELECT doc_id, 10 + (90 * len(terms) * all_docs) // all_terms AS m FROM own, sums WHERE len(terms) > 0
        ), counts AS (
            SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM own) GROUP BY ALL
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * all_docs + 2) / (2 * count(*) + 1)))::bigint AS w
            FROM counts, sums GROUP BY term, all_docs
        ), asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), scored AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint AS score
            FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN shapes USING (doc_id)
            GROUP BY ALL
        )
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::int AS rank, doc_id, score
        FROM scored WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
    """,
    "op13_line_dedup": r"""
        WITH parted AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), lines AS (
            SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM parted
        ), keyed AS (
            SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ), common AS (
            SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 20
            GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ), judged AS (
            SELECT k.*, coalesce(doc_id <> largest, false) AS gone FROM keyed k LEFT JOIN common USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
}
