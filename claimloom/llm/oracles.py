"""DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

#: Words of every document: A-Z in lower case, split at the six ASCII spaces.
_WORDS = r"""
    SELECT doc_id, text, list_filter(
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM documents
"""

#: Distinct 5-word shingles; fewer words are one shingle.
_SHINGLES = f"""
    words AS ({_WORDS}),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM words WHERE len(ws) > 0)
    )
"""


def near_duplicates(percent: int) -> str:
    return f"""
    WITH RECURSIVE {_SHINGLES},
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
        SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
    ),
    links AS (
        SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
        WHERE 100 * k >= {percent} * (x.n + y.n - k)
    ),
    reach AS (
        SELECT doc_id AS node, doc_id AS seen FROM documents
        UNION
        SELECT reach.node, links.v FROM reach JOIN links ON links.u = reach.seen
    ),
    roots AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d JOIN roots ON node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
    """


#: Counts of every text, repeated 3-word windows, and lines in more than 30 documents of a source.
_LINE_RULES = r"""
    WITH rows AS (
        SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
            list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
        FROM documents
    ),
    lines AS (
        SELECT doc_id, host, line, regexp_split_to_array(line, '[\x20\x09-\x0D]+') AS raw
        FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM rows)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
    ),
    keyed AS (
        SELECT doc_id, host, line, lower(array_to_string(list_filter(raw, lambda x: x <> ''), ' ')) AS k,
            len(list_filter(raw, lambda x: x <> '')) AS n
        FROM lines
    ),
    hot AS (SELECT host, k FROM keyed GROUP BY host, k HAVING count(DISTINCT doc_id) > 30),
    removed AS (SELECT doc_id, sum(n) AS n FROM keyed SEMI JOIN hot USING (host, k) GROUP BY doc_id),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM keyed GROUP BY doc_id),
    grams AS (
        SELECT doc_id, i, array_to_string(ws[i : i + 2], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM rows WHERE len(ws) >= 3)
    ),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM grams) WHERE c > 1),
    covered AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) t(o) GROUP BY doc_id),
    counts AS (
        SELECT rows.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
            (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
            coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
            coalesce(removed.n, 0)::BIGINT AS removed_words
        FROM rows LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN removed USING (doc_id)
    )
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * removed_words <= 50 * n_words AS kept
    FROM counts
"""


#: Items and documents by shared 5-word shingles.
_CONTAINED = f"""
    WITH {_SHINGLES},
    item_words AS (
        SELECT item_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
        FROM benchmark
    ),
    items AS (
        SELECT DISTINCT item_id, array_to_string(ws[i : i + 4], ' ') AS s
        FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM item_words WHERE len(ws) > 0)
    ),
    item_sizes AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id),
    shared AS (SELECT doc_id, item_id, count(*) AS k FROM shingles JOIN items USING (s) GROUP BY ALL)
    SELECT doc_id, item_id, k::BIGINT AS shared, n::BIGINT AS item_shingles
    FROM shared JOIN item_sizes USING (item_id) WHERE 100 * k >= 80 * n
"""


#: Sources in code point order share the words by weight, up to twice their size; rows are read in the order of a hash.
_CURRICULUM = r"""
    WITH RECURSIVE rows AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
            md5(coalesce(doc_id::VARCHAR, '')) AS k
        FROM documents
    ),
    sources AS (
        SELECT source, size, [3, 1, 2][turn + 1] AS weight, turn, sum(size) OVER () * 1.5 AS wanted
        FROM (SELECT source, sum(size)::BIGINT AS size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM rows GROUP BY source)
    ),
    rounds AS (
        SELECT 0 AS round, 0::HUGEINT AS full_size, sum(weight) AS open_weight, 0 AS stopped, -1 AS before FROM sources
        UNION ALL
        SELECT round + 1, sum(CASE WHEN above THEN 2 * size ELSE 0 END), sum(CASE WHEN above THEN 0 ELSE weight END), count_if(above), any_value(stopped)
        FROM (
            SELECT round, stopped, size, weight, (wanted - full_size) * weight / open_weight > 2 * size AS above
            FROM rounds, sources WHERE stopped <> before
        )
        GROUP BY round
    ),
    last AS (SELECT * FROM rounds ORDER BY round DESC LIMIT 1),
    targets AS (SELECT source, size, turn, least((wanted - full_size) * weight / open_weight, 2 * size)::DOUBLE AS target FROM sources, last),
    placed AS (
        SELECT r.*, t.size AS source_size, target, turn,
            (sum(r.size) OVER (PARTITION BY r.source ORDER BY k, r.size ROWS UNBOUNDED PRECEDING) - r.size)::BIGINT AS start
        FROM rows r JOIN targets t ON t.source IS NOT DISTINCT FROM r.source
    ),
    taken AS (
        SELECT *, greatest(least(size, floor(target)::BIGINT - start), 0) AS once,
            greatest(least(size, floor(target)::BIGINT - start - source_size), 0) AS again, start / target AS f,
            CASE turn WHEN 0 THEN -1.0 WHEN 1 THEN 0.0 ELSE 1.0 END::DOUBLE AS slope,
            CASE turn WHEN 0 THEN 1.5 WHEN 1 THEN 1.0 ELSE 0.5 END::DOUBLE AS w0
        FROM placed
    )
    SELECT doc_id, size, source_size, target, (once + again)::BIGINT AS taken,
        CASE WHEN once > 0 THEN floor(CASE WHEN f > 0 THEN 2 * f / (w0 + sqrt(w0 * w0 + 2 * slope * f)) ELSE 0 END * 1e9) END::BIGINT AS position,
        ((once > 0)::INT + (again > 0)::INT) AS n_reads
    FROM taken
"""


#: Anchors against all rows by component.
_HARD_NEGATIVES = """
    WITH vectors AS (
        SELECT DISTINCT vec_id, embedding, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    parts AS (
        SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, unnest(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS x
        FROM vectors
    ),
    scores AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, sum(a.x * b.x)::BIGINT AS score
        FROM parts a JOIN parts b USING (i) WHERE a.vec_id % 100 = 0 GROUP BY ALL
    ),
    labelled AS (
        SELECT anchor_id, s.vec_id, score, a.label = b.label AS same
        FROM scores s JOIN vectors a ON a.vec_id = anchor_id JOIN vectors b ON b.vec_id = s.vec_id
    ),
    positives AS (
        SELECT * FROM labelled WHERE same AND vec_id <> anchor_id
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT p.anchor_id, p.vec_id AS positive_id,
        row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
        n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN labelled n ON n.anchor_id = p.anchor_id AND NOT n.same
        AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
    QUALIFY rank <= 10
"""


_FILL_IN_MIDDLE = """
    WITH rows AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    numbers AS (
        SELECT doc_id, text, length(text) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
            ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
        FROM rows
    ),
    cuts AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
            CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM numbers
    ),
    parts AS (SELECT *, substr(text, 1, a) AS p, substr(text, a + 1, b - a) AS m, substr(text, b + 1) AS s FROM cuts)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(text) AS restored_sha256
    FROM parts
"""


ORACLES: dict[str, str] = {
    "op3_decontaminate": _CONTAINED,
    "op9_near_dedup": near_duplicates(85),
    "op8_line_rules": _LINE_RULES,
    "op11_curriculum": _CURRICULUM,
    "op12_hard_negatives": _HARD_NEGATIVES,
    "op13_fill_in_middle": _FILL_IN_MIDDLE,
}
