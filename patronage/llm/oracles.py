"""The queries that DuckDB can state, in SQL."""

from __future__ import annotations

ORACLES = {
    "op1_exact_dedup": """
WITH normal AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS norm
    FROM documents
), groups AS (
    SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
       sha256(norm) AS text_sha256
FROM normal JOIN groups USING (norm)
""",
    "op11_spelling_variants": """
WITH RECURSIVE bytes AS (
    SELECT list(c ORDER BY b) AS crc FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)),
            lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) t(b))
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(strlen(name)),
            lambda i: ('0x' || substr(hex(encode(name)), 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, crc[xor(c & 255, b) + 1]))) AS h
    FROM (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || run AS name FROM counted), bytes
), spelt AS (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INTEGER)
                    || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, n AS met
    FROM hashed
), words AS (
    SELECT word, sum(met)::BIGINT AS n FROM spelt
    WHERE length(word) >= 7 GROUP BY word HAVING sum(met) >= 2
), gaps AS (
    SELECT word, n, i, left(word, i::INTEGER - 1) || substr(word, i::INTEGER + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word, b.word AS other, b.n FROM gaps a JOIN gaps b
        ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM words a JOIN gaps b ON a.word = b.rest
    UNION
    SELECT b.word, a.word, a.n FROM words a JOIN gaps b ON a.word = b.rest
), best AS (
    SELECT word, count(*) AS n_near, max(n) AS n, min(other) FILTER (n = most) AS form FROM (
        SELECT *, max(n) OVER (PARTITION BY word) AS most FROM near) GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
           CASE WHEN b.n >= 10 * w.n THEN b.form END AS form,
           CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n
    FROM words w LEFT JOIN best b USING (word)
), chain AS (
    SELECT word, word AS root, form AS next FROM formed
    UNION ALL
    SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON c.next = f.word
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL
""",
    "op13_hard_negatives": """
WITH usable AS (
    SELECT row_number() OVER () AS uid, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda v: floor(256 * v::DOUBLE)) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda v: coalesce(isfinite(v), false))) = len(embedding)
), scored AS (
    SELECT a.uid AS anchor, a.vec_id AS anchor_id, c.uid, c.vec_id, a.label = c.label AS same,
           list_inner_product(a.x, c.x)::BIGINT AS score
    FROM usable a JOIN usable c ON a.uid <> c.uid
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, uid) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.uid ORDER BY n.score DESC, n.vec_id, n.uid)::INTEGER
           AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.uid ORDER BY n.score DESC, n.vec_id, n.uid) <= 10
""",
}
