"""DuckDB SQL for the operators that SQL can express."""

#: Square-root targets, Pfair windows and earliest deadlines, one block a step; see mixing.schedule().
OP2 = """
WITH RECURSIVE docs AS (
    SELECT doc_id, source, ('0x' || substr(md5(coalesce(cast(doc_id AS varchar), '') || ':' || coalesce(text, '')), 1, 15))::bigint AS h
    FROM documents
), sizes AS (
    SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS FIRST) AS k, floor(sqrt(count(*) * 1e12))::hugeint AS w
    FROM docs GROUP BY source
), whole AS (
    SELECT greatest(64, ceil(sum(n) / 1e6))::bigint AS block_rows, sum(w)::hugeint AS total, max(k) AS sources FROM sizes
), src AS (
    SELECT list({'blocks': ceil(n / block_rows)::hugeint, 'w': w, 'total': total} ORDER BY k) AS s, any_value(sources) AS sources FROM sizes, whole
), steps AS (
    SELECT 0::hugeint AS t, list_transform(range(sources), lambda i: 0::hugeint) AS done, NULL::struct(d hugeint, win hugeint, k bigint, r hugeint, j hugeint) AS pick, NULL::hugeint AS slot FROM src
    UNION ALL
    SELECT turn + 1, list_transform(range(1, sources + 1), lambda i: done[i] + (i = chosen.k)::hugeint), chosen, turn FROM (
        SELECT turn, done, sources, list_sort(list_filter(ready, lambda x: x.r <= turn))[1] AS chosen FROM (
            SELECT ready, done, sources, greatest(t, list_min(list_transform(ready, lambda x: x.r))) AS turn FROM (
                SELECT t, done, sources, list_transform(list_filter(range(1, sources + 1), lambda i: done[i] < s[i].blocks), lambda i: {
                    'd': (done[i] + 1) * s[i].total // s[i].w + ((done[i] + 1) * s[i].total % s[i].w > 0)::hugeint,
                    'win': (done[i] + 1) * s[i].total // s[i].w + ((done[i] + 1) * s[i].total % s[i].w > 0)::hugeint - done[i] * s[i].total // s[i].w,
                    'k': i, 'r': done[i] * s[i].total // s[i].w, 'j': done[i]}) AS ready
                FROM steps, src
            ) WHERE len(ready) > 0
        )
    )
), ranked AS (
    SELECT doc_id, docs.source, k, row_number() OVER (PARTITION BY k ORDER BY h, doc_id) - 1 AS nth, block_rows
    FROM docs JOIN sizes ON docs.source IS NOT DISTINCT FROM sizes.source, whole
)
SELECT doc_id, source, nth // block_rows AS block, slot::bigint AS slot, pick.r::bigint AS release, pick.d::bigint AS deadline, (nth % block_rows)::int AS in_block
FROM ranked JOIN steps ON pick.k = ranked.k AND pick.j = nth // block_rows
"""

#: All pairs of different word sequences that share a shingle, compared exactly; see neardup.classes_of().
OP8 = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), classes AS (
    SELECT array_to_string(w, ' ') AS t, min(doc_id) AS rep, count(*) AS n_copies, any_value(w) AS w FROM words WHERE len(w) > 0 GROUP BY 1
), shingles AS (
    SELECT DISTINCT rep, s FROM (
        SELECT rep, unnest(CASE WHEN len(w) < 5 THEN [t] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM classes
    )
), sizes AS (
    SELECT rep, count(*) AS n FROM shingles GROUP BY rep
), common AS (
    SELECT x.rep AS a, y.rep AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.rep < y.rep GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN sizes p ON p.rep = a JOIN sizes q ON q.rep = b WHERE 5 * c >= 4 * (p.n + q.n - c)
), ends AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
    SELECT a, b FROM ends UNION SELECT reached.a, ends.b FROM reached JOIN ends ON reached.b = ends.a
), roots AS (
    SELECT a AS rep, least(a, min(b)) AS root FROM reached GROUP BY a
), degrees AS (
    SELECT a AS rep, count(*) AS n_links FROM ends GROUP BY a
)
SELECT words.doc_id, CASE WHEN len(words.w) = 0 THEN words.doc_id ELSE coalesce(root, classes.rep) END AS class_id, coalesce(n_links, 0) AS n_links, coalesce(n_copies, 1) AS n_copies
FROM words LEFT JOIN classes ON len(words.w) > 0 AND classes.t = array_to_string(words.w, ' ')
LEFT JOIN roots ON roots.rep = classes.rep LEFT JOIN degrees ON degrees.rep = classes.rep
"""

#: Every document scored for every item; see ranked.search().
OP11 = """
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t, row_number() OVER () AS k FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t, row_number() OVER () AS q FROM benchmark
), whole AS (
    SELECT count(*) FILTER (len(t) > 0) AS nd, sum(len(t))::bigint AS l FROM docs
), tfs AS (
    SELECT k, doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT k, doc_id, len(t) AS n, unnest(t) AS term FROM docs) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(nd) + 2)::double / (2 * count(*) + 1)))::bigint AS w FROM tfs, whole GROUP BY term
), wanted AS (
    SELECT q, item_id, term, count(*) AS c FROM (SELECT q, item_id, unnest(t) AS term FROM items) GROUP BY ALL
), scores AS (
    SELECT q, item_id, k, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nd) // l))))::bigint AS score
    FROM wanted JOIN weights USING (term) JOIN tfs USING (term), whole GROUP BY ALL
)
SELECT item_id, rank::int AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, k) AS rank FROM scores WHERE score > 0
) WHERE rank <= 20
"""

#: Integer products of every anchor with every row; see negatives.mine().
OP12 = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS v, row_number() OVER () AS k
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT a.k AS ak, a.vec_id AS anchor_id, b.k AS bk, b.vec_id AS id, a.label = b.label AS same, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::bigint AS score
    FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.k <> b.k
), positives AS (
    SELECT ak, anchor_id, bk, id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY ak ORDER BY score DESC, id NULLS LAST, bk) <= 5
)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::int AS rank, n.id AS negative_id, positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.ak = p.ak AND NOT n.same AND 50 * positive_score <= 100 * n.score AND 100 * n.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.ak, p.bk ORDER BY n.score DESC, n.id NULLS LAST, n.bk) QUALIFY row_number() OVER w <= 3
"""

ORACLE = {"op2_mixing": OP2, "op8_ngram_jaccard": OP8, "op11_ranked_search": OP11, "op12_hard_negatives": OP12}
