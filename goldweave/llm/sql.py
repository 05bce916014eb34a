"""SQL (DuckDB) of the registered queries that SQL can express."""

from __future__ import annotations

WORDS = r"[^\x20\x09-\x0D]+"

OP1 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
    SELECT *, contains(role, '### ') OR contains(text, '### ') OR contains(role, '</turn>')
           OR contains(text, '</turn>') OR contains(role, chr(10)) OR suffix(role, '\') AS escaped
    FROM turns
), sized AS (
    SELECT *, length(role) + length(text) + length('### ' || ':' || chr(10) || chr(10) || '</turn>' || chr(10))
        + CASE WHEN escaped THEN 1
            + length(role) - length(replace(role, '\', ''))
            + (length(role) - length(replace(role, '### ', ''))) // 4
            + (length(role) - length(replace(role, '</turn>', ''))) // 7
            + length(role) - length(replace(role, chr(10), ''))
            + length(text) - length(replace(text, '\', ''))
            + (length(text) - length(replace(text, '### ', ''))) // 4
            + (length(text) - length(replace(text, '</turn>', ''))) // 7
          ELSE 0 END AS chars
    FROM marked
), joined AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
        sum(chars) AS chars, sum(escaped::INT) AS escaped
    FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
    sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars, escaped::BIGINT AS n_escaped
FROM joined
"""

OP8 = rf"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORDS}'))::BIGINT AS size,
        md5(coalesce(doc_id::VARCHAR, '')) AS place
    FROM documents
), sources AS (
    SELECT source, source_size, rank, [3, 1, 2][rank % 3 + 1] AS weight,
        [[1.5::DOUBLE, 1.0, 0.5], [1.0::DOUBLE, 1.0, 1.0], [0.5::DOUBLE, 1.0, 1.5]][rank % 3 + 1] AS w
    FROM (SELECT source, sum(size)::BIGINT AS source_size,
              row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
          FROM sized GROUP BY source)
), filled AS (
    SELECT 0 AS round, source, source_size, weight, w, false AS is_full,
        (SELECT sum(source_size) FROM sources) * 150 AS room, (SELECT sum(weight) FROM sources) AS share
    FROM sources
    UNION ALL
    SELECT round + 1, source, source_size, weight, w, is_full,
        ((SELECT sum(source_size) FROM sources) * 150
         - coalesce(sum(CASE WHEN is_full THEN source_size * 200 END) OVER (), 0)),
        coalesce(sum(CASE WHEN NOT is_full THEN weight END) OVER (), 0)
    FROM (SELECT round, source, source_size, weight, w,
              is_full OR room * weight >= source_size * 200 * share AS is_full
          FROM filled WHERE round < (SELECT count(*) FROM sources))
), targets AS (
    SELECT source, source_size, w, CASE WHEN is_full THEN (2 * source_size)::DOUBLE
        ELSE (room * weight)::DOUBLE / greatest(100 * share, 1)::DOUBLE END AS target
    FROM filled WHERE round = (SELECT max(round) FROM filled)
), run AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, t.w, coalesce(sum(d.size) OVER (
            PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), passes AS (
    SELECT *, greatest(least(round(target)::BIGINT - start, size), 0) AS one,
        greatest(least(round(target)::BIGINT - start - source_size, size), 0) AS two
    FROM run
), due AS (
    SELECT *, CASE WHEN one > 0 THEN start ELSE start + source_size END::DOUBLE / greatest(target, 1.0)
        * ((w[1] + w[2]) / 2 + (w[2] + w[3]) / 2) AS wanted, (w[1] + w[2]) / 2 AS half
    FROM passes
), piece AS (
    SELECT *, CASE WHEN wanted >= half THEN 1 ELSE 0 END AS k,
        CASE WHEN wanted >= half THEN wanted - half ELSE wanted END AS rest,
        CASE WHEN wanted >= half THEN w[2] ELSE w[1] END AS low,
        CASE WHEN wanted >= half THEN w[3] - w[2] ELSE w[2] - w[1] END AS slope
    FROM due
)
SELECT doc_id, size, source_size, target, (one + two)::BIGINT AS taken,
    CASE WHEN one + two > 0 THEN round((k + CASE WHEN rest <= 0 THEN 0.0
        ELSE 2 * rest / (low + sqrt(greatest(low * low + 2 * slope * rest, 0.0))) END) / 2, 6) END AS position
FROM piece
"""

OP10 = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w,
        string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
), windows AS (
    SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM (
        SELECT r, i, count(*) OVER (PARTITION BY r, tri) AS n FROM (
            SELECT r, i, w[i] || chr(32) || w[i + 1] || chr(32) || w[i + 2] AS tri
            FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM docs)))
    WHERE n > 1
), repeats AS (
    SELECT r, sum(CASE WHEN before IS NULL THEN 3 ELSE least(3, i - before) END)::BIGINT AS n_repeat_words
    FROM windows GROUP BY r
), raw AS (
    SELECT r, source, text, unnest(lines) AS line FROM docs
), plain AS (
    SELECT r, source, text, line, regexp_replace(regexp_replace(lower(line), '[ \t\x0B\f\r]+', ' ', 'g'),
        '^ | $', '', 'g') AS norm,
        len(regexp_extract_all(line, '{WORDS}')) AS n
    FROM raw
), dups AS (
    SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM plain WHERE n > 0 GROUP BY r
), frequent AS (
    SELECT a.source, a.norm FROM (
        SELECT source, norm, count(DISTINCT text) AS n FROM plain WHERE norm <> '' GROUP BY ALL) a
    JOIN (SELECT source, count(DISTINCT text) AS size FROM docs GROUP BY source) b
        ON a.source IS NOT DISTINCT FROM b.source
    WHERE n >= 10 AND n * 1000 >= size * 10
), gone AS (
    SELECT p.r, count(*) AS n_frequent_lines, sum(p.n) AS n_frequent_words
    FROM plain p JOIN frequent f ON p.source IS NOT DISTINCT FROM f.source AND p.norm = f.norm GROUP BY p.r
), facts AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(n_frequent_lines, 0)::BIGINT AS n_frequent_lines,
        coalesce(n_frequent_words, 0)::BIGINT AS n_frequent_words
    FROM docs LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r) LEFT JOIN gone USING (r)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND NOT ((n_words - n_frequent_words) * 100 < n_words * 30) AS kept
FROM facts
"""


OP11 = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
    FROM whole a JOIN whole r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w::INT AS rank, s.vec_id AS negative_id, positive_score,
    s.score AS negative_score
FROM positives JOIN scored s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10
"""


def lloyd(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds written out: book k from the entries of book k - 1."""
    def assigned(k: int) -> str:
        # the part's own square is the same for all entries
        return f"""
            SELECT m.r, m.p, m.part, arg_min(b.e, {{'d': b.square - 2 * list_dot_product(m.part, b.entry), 'e': b.e}}) AS e
            FROM members m JOIN book{k} b USING (p) GROUP BY ALL"""

    steps = [f"""
whole AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), members AS MATERIALIZED (
    SELECT r, vec_id, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS part
    FROM whole, range({parts}) t(p)
), book0 AS MATERIALIZED (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, part AS entry,
        list_dot_product(part, part) AS square
    FROM members QUALIFY e < {entries}
)"""]
    for k in range(1, rounds + 1):
        steps.append(f"""
round{k} AS MATERIALIZED ({assigned(k - 1)}
), mean{k} AS MATERIALIZED (
    SELECT p, e, list(floor(total / n) ORDER BY i) AS entry FROM (
        SELECT p, e, i, sum(x)::BIGINT AS total, count(*) AS n
        FROM (SELECT p, e, unnest(part) AS x, unnest(range(len(part))) AS i FROM round{k}) GROUP BY p, e, i)
    GROUP BY p, e
), book{k} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.entry, b.entry) AS entry,
        list_dot_product(coalesce(m.entry, b.entry), coalesce(m.entry, b.entry)) AS square
    FROM book{k - 1} b LEFT JOIN mean{k} m USING (p, e)
)""")
    return f"""
WITH {",".join(steps)}, final AS ({assigned(rounds)}
), coded AS (
    SELECT f.r, string_agg(printf('%02x', f.e), '' ORDER BY f.p) AS code,
        sum(list_dot_product(part, part) + square - 2 * list_dot_product(part, entry))::BIGINT AS error
    FROM final f JOIN book{rounds} b USING (p, e) GROUP BY f.r
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(array_to_string(list_transform(entry, lambda x: x::BIGINT), ','), ',' ORDER BY p, e))
     FROM book{rounds}) AS codebooks_sha256
FROM whole JOIN coded USING (r)
"""


OP13 = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
    row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
    sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def statements() -> dict[str, str]:
    return {
        "op1_chat_formatting": OP1, "op8_source_mixing": OP8, "op10_quality_rules": OP10, "op11_hard_negatives": OP11,
        "op12_vector_codes": lloyd(), "op13_exact_dedup": OP13,
    }
