"""DuckDB SQL for the queries that SQL can express, written independently of the Spark code."""

from __future__ import annotations

from tiercast.llm.licenses import LEAST_DICE, NOTICES
from tiercast.llm.mixing import BLOCK_WORDS, SEED

_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

EXACT_DEDUP = f"""
WITH texts AS (SELECT doc_id, {_NORMAL} AS t FROM documents)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY t)
"""

# The shares are found by repeated capping, the seats by ranking all quotients, and the
# positions by one running sum per source.
MIXING = rf"""
WITH RECURSIVE sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')) AS k
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) AS number
    FROM sizes GROUP BY source
), weighted AS (
    SELECT *, [5, 2, 1][((number - 1) % 3 + 1)::INT] AS w, 3 * source_size AS cap FROM sources
), rounds AS (
    SELECT 0 AS step, number, source_size, w, cap, false AS capped,
           sum(source_size) OVER () AS total, 0::HUGEINT AS fixed, sum(w) OVER () AS w_left
    FROM weighted
    UNION ALL
    SELECT step + 1, number, source_size, w, cap, over_cap, total,
           sum(CASE WHEN over_cap THEN cap ELSE 0 END) OVER (),
           sum(CASE WHEN over_cap THEN 0 ELSE w END) OVER ()
    FROM (SELECT *, capped OR ((total - fixed) * w)::DOUBLE > cap::DOUBLE * w_left AS over_cap,
                 step AS s FROM rounds)
    WHERE step < (SELECT count(*) FROM weighted) AND total > 0
), last_round AS (
    SELECT *, CASE WHEN capped THEN cap::DOUBLE ELSE ((total - fixed) * w)::DOUBLE / w_left END
              AS target
    FROM rounds WHERE step = (SELECT max(step) FROM rounds)
), quotients AS (
    SELECT number, target / (2 * seat + 1) AS q, seat
    FROM last_round, LATERAL (SELECT unnest(generate_series(0,
        (target / {BLOCK_WORDS})::BIGINT + (SELECT count(*) FROM weighted))) AS seat)
    WHERE target > 0
), won AS (
    SELECT number, count(*) AS blocks
    FROM (SELECT number, row_number() OVER (ORDER BY q DESC, number, seat) AS place FROM quotients)
    WHERE place <= (SELECT sum(source_size) // {BLOCK_WORDS} FROM sources)
    GROUP BY number
), quotas AS (
    SELECT source, source_size, target, least(coalesce(blocks, 0) * {BLOCK_WORDS}, cap) AS words,
           ('0x' || substr(md5('{SEED}|' || coalesce(source, '')), 1, 12))::BIGINT
               % greatest(ceil(source_size / {BLOCK_WORDS})::BIGINT, 1) * {BLOCK_WORDS} AS start
    FROM weighted JOIN last_round USING (number, source_size, w, cap)
    LEFT JOIN won USING (number)
), placed AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id
                              ROWS UNBOUNDED PRECEDING) - size AS first
    FROM sizes
), runs AS (
    SELECT doc_id, size, source_size, target, first, start,
           CASE WHEN source_size = 0 THEN 0 ELSE words // source_size END AS passes,
           CASE WHEN source_size = 0 THEN 0 ELSE words % source_size END AS run
    FROM placed JOIN quotas ON placed.source IS NOT DISTINCT FROM quotas.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (passes * size
        + greatest(least(first + size, start + run, source_size) - greatest(first, start), 0)
        + greatest(least(first + size, start + run - source_size) - first, 0))::BIGINT AS taken
FROM runs
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_scan() -> str:
    notices = ", ".join(
        f"({place}, {_quoted(name)}, {_quoted(text)})"
        for place, (name, text) in enumerate(NOTICES.items())
    )

    def grams(words: str) -> str:
        return (
            f"list_distinct([{words}[i] || ' ' || {words}[i + 1]"
            f" FOR i IN generate_series(1, len({words}) - 1)])"
        )

    words = "regexp_extract_all(lower({}), '[a-z0-9]+')"
    return f"""
    WITH notices(place, license, notice) AS (VALUES {notices}),
    templates AS (
        SELECT place, license, {grams("w")} AS g
        FROM (SELECT *, {words.format("notice")} AS w FROM notices)
    ), lines AS (
        SELECT row_number() OVER () AS line, doc_id, w
        FROM (SELECT doc_id, {words.format("t")} AS w
              FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS t FROM documents))
        WHERE len(w) > 1
    ), scored AS (
        SELECT line, doc_id, place, license,
               2 * len(list_intersect(l.g, t.g))::DOUBLE / (len(l.g) + len(t.g)) AS dice
        FROM (SELECT line, doc_id, {grams("w")} AS g FROM lines) l, templates t
    ), found AS (SELECT * FROM scored WHERE dice >= {LEAST_DICE}),
    best AS (
        SELECT doc_id, count(DISTINCT line) AS n_lines, max(dice) AS dice,
               arg_min(license, (-dice, place)) AS license
        FROM found GROUP BY doc_id
    )
    SELECT doc_id, license, dice, coalesce(n_lines, 0)::BIGINT AS n_lines
    FROM documents LEFT JOIN best USING (doc_id)
    """


VECTOR_DEDUP = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND list_aggregate(embedding, 'count') = len(embedding)
      AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
     AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reached(vec_id, other) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT reached.vec_id, links.b FROM reached JOIN links ON reached.other = links.a
)
SELECT e.vec_id,
       (SELECT count(*) FROM links WHERE links.a = e.vec_id) AS n_links,
       r.component_id,
       e.vec_id = r.component_id AS kept
FROM embeddings e
JOIN (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id) r USING (vec_id)
"""

# All pairs that share a shingle, by weighted Jaccard similarity of the word shingles.
NEAR_DUP = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '([a-z0-9]|[^\x00-\x7F])+') AS w
    FROM documents
), shingles AS (
    SELECT doc_id, shingle, count(*) AS n
    FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5
                 THEN [array_to_string(w, ' ')]
                 ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN generate_series(1, len(w) - 4)]
                 END) AS shingle FROM words)
    GROUP BY doc_id, shingle
), totals AS (SELECT doc_id, sum(n) AS total FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS common
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM shared JOIN totals x ON x.doc_id = a JOIN totals y ON y.doc_id = b
    WHERE common >= 0.8 * (x.total + y.total - common)
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a
), classes AS (SELECT doc_id, min(other) AS class_id FROM reached GROUP BY doc_id)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size,
       doc_id = class_id AS kept
FROM classes
"""


# Every item against every document that holds one of its terms.
RANKED_SEARCH = r"""
WITH tokens AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), held AS (
    SELECT doc_id, term, count(*)::BIGINT AS tf FROM tokens GROUP BY doc_id, term
), sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY doc_id),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS len FROM sizes),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*)::BIGINT AS df FROM held GROUP BY term), corpus
), wanted AS (
    SELECT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT item_id, doc_id, sum(
        w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // len))))::BIGINT AS score
    FROM wanted JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), corpus
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

# Every anchor against every vector.
HARD_NEGATIVES = """
WITH vectors AS (
    SELECT vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
           list_inner_product(a.v, c.v)::BIGINT AS score
    FROM vectors a JOIN vectors c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v)
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id
                          ORDER BY score DESC, other_id)::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_dart_minhash": NEAR_DUP,
        "op4_license_scan": license_scan(),
        "op6_mixing": MIXING,
        "op7_exact_dedup": EXACT_DEDUP,
        "op10_vector_dedup": VECTOR_DEDUP,
        "op12_ranked_search": RANKED_SEARCH,
        "op13_hard_negatives": HARD_NEGATIVES,
    }
