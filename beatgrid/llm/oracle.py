"""DuckDB SQL for the operators that SQL can express."""

_SPACE = r"\x20\x09-\x0D"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op4_ngram_join": rf"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^{_SPACE}]+') AS w FROM documents
        ),
        shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS shingle
            FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM split WHERE len(w) > 0)
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            JOIN sizes s ON s.doc_id = a.doc_id JOIN sizes t ON t.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, s.n, t.n HAVING 100 * count(*) >= 85 * (s.n + t.n - count(*))
        ),
        reached AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
        ),
        components AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM components LEFT JOIN sizes USING (doc_id)
    """,
    "op6_line_dedup": rf"""
        WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place FROM split),
        keyed AS (
            SELECT *, {_LOWER.format(
                f"regexp_replace(regexp_replace(line, '^[{_SPACE}]+', ''), '[{_SPACE}]+$', '')"
            )} AS key
            FROM lines
        ),
        owners AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key),
        marked AS (SELECT k.*, coalesce(owner < doc_id, false) AS dropped FROM keyed k LEFT JOIN owners USING (key))
        SELECT
            doc_id,
            count(*) AS n_lines,
            count(*) FILTER (WHERE dropped) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op10_substring_dedup": rf"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') AS w FROM documents
        ),
        placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM split),
        windows AS (
            SELECT doc_id, place, md5(array_to_string(w[place : place + 49], ' ')) AS content
            FROM placed JOIN split USING (doc_id) WHERE place + 49 <= len(w)
        ),
        owners AS (SELECT content, min(doc_id) AS owner FROM windows GROUP BY content),
        repeated AS (SELECT doc_id, place, owner < doc_id AS again FROM windows JOIN owners USING (content)),
        marked AS (
            SELECT p.*, coalesce(max(again) OVER (
                PARTITION BY p.doc_id ORDER BY p.place ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
            FROM placed p LEFT JOIN repeated r ON r.doc_id = p.doc_id AND r.place = p.place
        ),
        counted AS (
            SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
                coalesce(string_agg(word, ' ' ORDER BY place) FILTER (WHERE NOT gone), '') AS kept
            FROM marked GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
            sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents LEFT JOIN counted USING (doc_id)
    """,
    "op12_lexical_search": r"""
        WITH found AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ),
        occurrences AS (SELECT doc_id, term, count(*) AS tf FROM found GROUP BY doc_id, term),
        sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM occurrences GROUP BY doc_id),
        whole AS (SELECT count(*) AS n_documents, sum(n)::BIGINT AS n_terms FROM sizes),
        measured AS (SELECT doc_id, 100 - 90 + ((90 * n * n_documents) // n_terms) AS m FROM sizes, whole),
        weights AS (
            SELECT term, floor(1000 * ln((2 * n_documents + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM occurrences, whole GROUP BY term, n_documents
        ),
        scored AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN occurrences USING (term) JOIN measured USING (doc_id)
            GROUP BY item_id, doc_id
        )
        SELECT item_id, (row_number() OVER best)::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0
        WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
        QUALIFY rank <= 10
    """,
    "op13_exact_dedup": r"""
        WITH normalised AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
        )
        SELECT
            doc_id,
            min(doc_id) OVER same AS keep_id,
            count(*) OVER same AS group_size,
            doc_id = min(doc_id) OVER same AS kept,
            sha256(body) AS text_sha256
        FROM normalised
        WINDOW same AS (PARTITION BY body)
    """,
}
