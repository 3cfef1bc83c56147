"""SQL that must give the same rows as a query, where SQL can say it."""

CONTAMINATION = r"""
WITH words AS (
    SELECT 'd' AS side, doc_id AS id, lower(coalesce(text, '')) AS t FROM documents WHERE doc_id IS NOT NULL
    UNION ALL SELECT 'i', item_id, lower(coalesce(text, '')) FROM benchmark WHERE item_id IS NOT NULL),
split AS (SELECT side, id, list_filter(string_split_regex(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM words),
shingles AS (
    SELECT DISTINCT side, id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT side, id, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)),
items AS (SELECT id, s, count(*) OVER (PARTITION BY id) AS q FROM shingles WHERE side = 'i'),
held AS (
    SELECT d.id AS doc_id, i.id AS item_id, i.q AS n_item, count(*) AS n_shared
    FROM shingles d JOIN items i USING (s) WHERE d.side = 'd' GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment FROM held WHERE 100 * n_shared >= 80 * n_item
"""

JACCARD_JOIN = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents WHERE doc_id IS NOT NULL),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) END AS s
    FROM split),
classes AS MATERIALIZED (SELECT min(doc_id) AS id, len(s) AS n, s FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS MATERIALIZED (SELECT id, n, unnest(s) AS x FROM classes),
links AS MATERIALIZED (
    SELECT a.id AS a, b.id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.id < b.id
    WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
    SELECT id, id AS other FROM classes
    UNION SELECT r.id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(k.component_id, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes c ON d.s = c.s LEFT JOIN component k ON c.id = k.id
"""

HARD_NEGATIVES = r"""
WITH rows AS MATERIALIZED (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS MATERIALIZED (
    SELECT a.id AS anchor_id, r.id AS id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM rows a JOIN rows r ON a.id <> r.id WHERE a.id % 50 = 0),
positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
    SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS rank,
        s.id AS negative_id, p.positive_score, s.score AS negative_score
    FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
    WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""

SPELLING = r"""
WITH RECURSIVE shifts AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)),
runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
        unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
    FROM documents),
held AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
summed AS (
    SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
            ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END))),
        lambda c, b: xor(c >> 8, shifts.t[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM held, shifts),
words AS MATERIALIZED (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word,
        CAST(sum(n) AS BIGINT) AS n
    FROM summed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
less AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
    SELECT DISTINCT a.word AS word, a.n AS n, b.word AS other, b.n AS m FROM less a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
best AS (
    SELECT word, n, count(*) OVER (PARTITION BY word) AS n_near, other, m FROM near
    QUALIFY row_number() OVER (PARTITION BY word ORDER BY m DESC, other) = 1),
forms AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 2 * w.n THEN b.other END AS form, CASE WHEN b.m >= 2 * w.n THEN b.m END AS form_n
    FROM words w LEFT JOIN best b USING (word)),
led AS (
    SELECT word, word AS root FROM forms
    UNION ALL SELECT l.word, f.form FROM led l JOIN forms f ON l.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, l.root, f.n, f.n_near, f.form_n
FROM forms f JOIN led l USING (word) JOIN forms e ON l.root = e.word WHERE e.form IS NULL
"""

ORACLES = {"op3_jaccard_join": JACCARD_JOIN, "op9_contamination": CONTAMINATION, "op11_hard_negatives": HARD_NEGATIVES, "op12_spelling": SPELLING}
