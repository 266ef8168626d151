"""Corpus queries in DuckDB's SQL, where SQL can express them. The others are tested against plain
versions.
"""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lowered_words() -> str:
    lower = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


ORACLES = {
    "op3_warc": """
        WITH digests AS (
            SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
        ),
        firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_page FROM digests)
        SELECT page_id, strlen(payload) AS payload_bytes,
               array_to_string(list_transform(
                   range(32),
                   lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                               ((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS INTEGER)
                                 >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1, 1)
               ), '') AS payload_digest,
               CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_page THEN first_page END AS refers_to,
               true AS digest_holds,
               url AS target_uri
        FROM firsts""",
    "op4_chat": """
        WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
        whole AS (
            SELECT conv_id, list({'r': role, 't': text} ORDER BY turn, role, text) AS s
            FROM turns GROUP BY conv_id
        ),
        beginnings AS (
            SELECT DISTINCT list_slice(s, 1, k) AS s FROM whole, unnest(range(1, len(s))) AS u(k)
        ),
        kept AS (SELECT min(conv_id) AS conv_id, count(*) AS n_same, s FROM whole GROUP BY s)
        SELECT conv_id, len(s) AS n_turns, n_same,
               array_to_string(list_transform(
                   s, lambda x: '<|im_start|>' || coalesce(x.r, '') || chr(10) || coalesce(x.t, '')
                           || '<|im_end|>' || chr(10)
               ), '') AS text
        FROM kept WHERE NOT EXISTS (SELECT 1 FROM beginnings b WHERE b.s = kept.s)""",
    "op7_decontaminate": rf"""
        WITH docs AS (SELECT doc_id, {_lowered_words()} AS w FROM documents),
        items AS (
            SELECT item_id, row_number() OVER (ORDER BY item_id) AS nth, w
            FROM (SELECT item_id, {_lowered_words()} AS w FROM benchmark) WHERE len(w) > 0
        ),
        windows AS (
            SELECT item_id, nth, p, list_slice(w, p + 1, p + 10) AS win
            FROM items, unnest(range(greatest(1, len(w) - 9))) AS u(p)
        ),
        sizes AS (SELECT DISTINCT len(win) AS size FROM windows),
        places AS (
            SELECT doc_id, s, list_slice(w, s + 1, s + size) AS win
            FROM docs, sizes, unnest(range(len(w) - size + 1)) AS u(s)
        ),
        matches AS (
            SELECT doc_id, s, len(win) AS size, item_id, nth, p FROM places JOIN windows USING (win)
        ),
        hits AS (
            SELECT doc_id, count(DISTINCT s + k) AS n_hit
            FROM matches, unnest(range(size)) AS u(k) GROUP BY doc_id
        ),
        found AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM matches) GROUP BY doc_id
        ),
        steps AS (
            SELECT *, s - row_number() OVER (PARTITION BY doc_id, nth, s - p ORDER BY s) AS run FROM matches
        ),
        runs AS (
            SELECT doc_id, item_id, nth, min(p) AS item_start, min(s) AS start, count(*) - 1 + max(size) AS words
            FROM steps GROUP BY doc_id, item_id, nth, s - p, run
        ),
        longest AS (
            SELECT * FROM runs
            QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY words DESC, start, nth, item_start) = 1
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated,
               CAST(coalesce(words, 0) AS BIGINT) AS longest_words, CAST(item_id AS VARCHAR) AS longest_item,
               item_start AS longest_item_start, start AS longest_start
        FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN longest USING (doc_id)""",
    "op8_quality_rules": r"""
        WITH words AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM documents
        ),
        triples AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS often
            FROM words, unnest(range(1, len(w) - 1)) AS u(i)
        ),
        repeats AS (
            SELECT doc_id, count(DISTINCT i + k) AS n
            FROM triples, unnest([0, 1, 2]) AS u(k) WHERE often > 1 GROUP BY doc_id
        ),
        measured AS (
            SELECT doc_id, len(w) AS n_words,
                   length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                   length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   len(lines) AS n_lines,
                   coalesce(n, 0) AS n_repeat_words,
                   len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_letter_words,
                   len(list_filter(w, lambda x: strlen(x) > 1 AND regexp_matches(x, '[A-Z]')
                                           AND NOT regexp_matches(x, '[a-z]'))) AS n_capital_words
            FROM words LEFT JOIN repeats USING (doc_id)
        ),
        ledger AS (
            SELECT *, CAST(
                CASE WHEN n_words < 50 THEN 1 ELSE 0 END
                + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
                + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
                + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
                + CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END
                + CASE WHEN n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines THEN 32 ELSE 0 END
                + CASE WHEN 10 * n_letter_words < 7 * n_words THEN 64 ELSE 0 END
                + CASE WHEN 2 * n_capital_words > n_words THEN 128 ELSE 0 END AS BIGINT) AS failures
            FROM measured
        )
        SELECT *, failures & 3 <> 0 AS base_failed, failures = 0 AS kept FROM ledger""",
    "op11_fill_in_middle": """
        WITH drawn AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents
        ),
        numbers AS (
            SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
                   CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
                   CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
            FROM drawn
        ),
        ends AS (
            SELECT *, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
                   greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b
            FROM numbers
        ),
        parts AS (
            SELECT *, coalesce(array_to_string(list_slice(units, 1, a), ''), '') AS prefix,
                   coalesce(array_to_string(list_slice(units, a + 1, b), ''), '') AS middle,
                   coalesce(array_to_string(list_slice(units, b + 1, len(units)), ''), '') AS suffix,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                             OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM ends
        )
        SELECT doc_id, CAST(len(units) AS BIGINT) AS n, form,
               CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                          WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                          ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts""",
}
