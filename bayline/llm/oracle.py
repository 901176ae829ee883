"""DuckDB counterparts of the operators that SQL can express."""

CHATS = """
WITH turns AS (
    SELECT DISTINCT conv_id, coalesce(turn, -1099511627776) AS turn, coalesce(role, '') AS role,
           coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), listed AS (
    SELECT conv_id, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n_turns,
           '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS turn_text
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
), prefixes AS (
    SELECT conv_id, pos, n_turns, string_agg(turn_text, '') OVER (
        PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix
    FROM listed
), ends AS (
    SELECT min(conv_id) AS conv_id, n_turns, prefix, count(*) AS copies
    FROM prefixes WHERE pos = n_turns GROUP BY n_turns, prefix
), kept AS (
    SELECT conv_id, n_turns, copies FROM ends
    WHERE NOT EXISTS (
        SELECT 1 FROM prefixes p
        WHERE p.pos = ends.n_turns AND p.prefix = ends.prefix AND p.pos < p.n_turns)
)
SELECT k.conv_id, k.n_turns, k.copies, CAST((l.pos - 1) // 64 AS INTEGER) AS piece,
       string_agg(l.turn_text, '' ORDER BY l.pos) AS text
FROM kept k JOIN listed l USING (conv_id)
GROUP BY k.conv_id, k.n_turns, k.copies, (l.pos - 1) // 64
"""

# The exponent in closed form: the ratio of the largest and the smallest source, to the power
# 1 - t, is the repetition limit; rounded up to the next millionth.
MIX = r"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
    FROM documents
), totals AS (
    SELECT source, sum(n_tokens) AS tokens FROM docs GROUP BY source
), ends AS (
    SELECT max(tokens) AS most, min(tokens) AS least FROM totals WHERE tokens > 0
), exponent AS (
    SELECT most, CASE WHEN most <= 2 * least THEN 0.0::DOUBLE
        ELSE ceil((1 - ln(2.0::DOUBLE) / ln(most::DOUBLE / least)) * 1000000 - 0.001) / 1000000 END AS t
    FROM ends
), planned AS (
    SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(most::DOUBLE / tokens, 1 - t) ELSE 1.0 END AS repeats
    FROM totals, exponent
), blocks AS (
    SELECT source, repeats, CAST(floor(repeats) AS BIGINT) AS whole,
           floor((repeats - floor(repeats)) * tokens) AS rest
    FROM planned
), copies AS (
    SELECT d.doc_id, d.source, d.n_tokens, b.repeats, b.whole, b.rest, e.epoch,
           CAST('0x' || substr(md5('mix:' || e.epoch || ':' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 15)
                AS BIGINT) AS key
    FROM docs d JOIN blocks b USING (source), (SELECT unnest(range(0, 4)) AS epoch) e
    WHERE e.epoch <= b.whole
), summed AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY key) AS upto FROM copies
)
SELECT doc_id, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(epoch AS INTEGER) AS epoch,
       round((epoch + key / 1152921504606846976.0::DOUBLE) / repeats, 6) AS place
FROM summed WHERE epoch < whole OR (rest > 0 AND upto <= rest)
"""

# Every pair that shares a shingle is compared, and groups grow by reachability.
NEAR_DUPS = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM split WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM shared s JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * s.n >= 75 * (x.n + y.n - s.n)
), ways AS (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
    SELECT a, b FROM ways
    UNION
    SELECT r.a, w.b FROM reached r JOIN ways w ON w.a = r.b
), least AS (
    SELECT a AS doc_id, min(b) AS other FROM reached GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(other, doc_id)) AS kept
FROM split LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""

# Every kept term in every group, counts of 0 among them.
DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), words AS (
    SELECT id, lang, source, unnest(terms) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), langs AS (
    SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), cells AS (
    SELECT w.lang, w.source, w.term, count(*) AS n
    FROM words w JOIN kept USING (lang, term) GROUP BY w.lang, w.source, w.term
), totals AS (
    SELECT lang, source, sum(n) AS total FROM cells GROUP BY lang, source
), groups AS (
    SELECT g.lang, g.source, coalesce(t.total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN totals t USING (lang, source)
), dense AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + l.v) AS p,
           1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + l.v) AS q
    FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
    LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY a.lang, a.source, b.source
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM dense WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""

# Every phrase of one to four words is listed and counted on its own.
COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), listed AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), phrases AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM listed), (SELECT unnest(range(1, 5)) AS m)
    WHERE i + m - 1 <= len(w) GROUP BY ALL
), totals AS (
    SELECT lang, sum(f) AS n FROM phrases WHERE m = 1 GROUP BY lang
), frequent AS (
    SELECT lang, m, phrase, f, string_split(phrase, ' ') AS w FROM phrases WHERE f >= 30
), cuts AS (
    SELECT lang, phrase, w, f AS a, m, unnest(range(1, m)) AS k FROM frequent WHERE m > 1
), weighed AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
    FROM cuts c
    JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')
), weakest AS (
    SELECT * FROM weighed QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), parts AS (
    SELECT lang, f, w, i, unnest(range(2, len(w) - i + 2)) AS size
    FROM (SELECT lang, f, w, unnest(range(1, len(w))) AS i FROM frequent WHERE m > 2)
), longer AS (
    SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(f) AS f
    FROM parts WHERE size < len(w) GROUP BY ALL
), kept AS (
    SELECT s.* FROM weakest s LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase
    WHERE o.f IS NULL OR 100 * o.f < 80 * s.a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
