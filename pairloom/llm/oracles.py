"""DuckDB SQL for the queries that SQL can express.

The others are tested in tests/llm against brute force, round trips or held-out accuracy: fingerprint hashes, learned models and
tokenizers have no SQL form, and cosines and sums of logarithms differ from SQL's in their last bits.
"""

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
windows AS (
    SELECT item_id, least(13, len(w)) AS k, array_to_string(w[a : a + least(13, len(w)) - 1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS a FROM item WHERE len(w) > 0)
),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS a FROM doc, (SELECT DISTINCT k FROM windows)),
found AS (SELECT p.doc_id, p.a, p.k, x.item_id FROM places p JOIN windows x ON x.k = p.k AND x.g = array_to_string(p.w[p.a : p.a + p.k - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + k)) AS place FROM found) GROUP BY 1),
held AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY 1)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)
"""

LINE_DEDUP = """
WITH lines AS (
    SELECT doc_id, coalesce(source, '') AS site, text AS whole, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
    FROM documents WHERE text IS NOT NULL
),
keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM lines),
bad AS (
    SELECT key, min(struct_pack(doc_id := doc_id, pos := pos)) AS first FROM keyed WHERE key <> ''
    GROUP BY key HAVING count(DISTINCT site) >= 10 AND count(DISTINCT whole) >= 20
),
marked AS (
    SELECT k.doc_id, k.pos, k.line, b.key IS NOT NULL AND struct_pack(doc_id := k.doc_id, pos := k.pos) <> b.first AS gone
    FROM keyed k LEFT JOIN bad b USING (key)
),
kept AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM marked GROUP BY 1)
SELECT d.doc_id, CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE coalesce(n, 0) END AS n_lines, coalesce(n_dropped, 0) AS n_dropped, md5(kept.text) AS text_md5, kept.text
FROM documents d LEFT JOIN kept USING (doc_id)
"""


def _spans(pattern: str, group: int) -> str:
    """List of (start, end, value) of a pattern's matches in text t."""
    return f"""list_transform(range(1, len(regexp_extract_all(t, {pattern})) + 1), lambda i: struct_pack(
        s := list_sum(list_transform(string_split_regex(t, {pattern})[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(regexp_extract_all(t, {pattern})[1:i - 1], lambda x: length(x))), 0),
        n := length(regexp_extract_all(t, {pattern})[i]), v := regexp_extract_all(t, {pattern}, {group})[i]))"""


_ASSIGN = """'(?i:(password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""
SECRETS = f"""
WITH doc AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS t FROM documents),
base AS (
    SELECT doc_id, owner, 0 AS rank, 'assign' AS kind, unnest({_spans(_ASSIGN, 2)}) AS x FROM doc
    UNION ALL SELECT doc_id, owner, 1, 'access', unnest({_spans("'AKIA[A-Z0-9]+'", 0)}) FROM doc
    UNION ALL SELECT doc_id, owner, 2, 'hex', unnest({_spans("'[0-9a-f]{32,}'", 0)}) FROM doc
),
found AS (
    SELECT doc_id, owner, rank, kind, CAST(x.s AS BIGINT) AS s, CAST(x.s + x.n AS BIGINT) AS e, x.v AS v FROM base
    WHERE length(x.v) >= CASE rank WHEN 0 THEN 8 WHEN 1 THEN 16 ELSE 32 END
),
long AS (SELECT doc_id, owner, unnest({_spans("'[A-Za-z0-9+/_-]{20,}'", 0)}) AS x FROM doc),
more AS (
    SELECT doc_id, owner, 3 AS rank, 'owned' AS kind, CAST(x.s AS BIGINT) AS s, CAST(x.s + x.n AS BIGINT) AS e, x.v AS v FROM long l
    WHERE regexp_matches(x.v, '[0-9]') AND regexp_matches(x.v, '[A-Za-z]')
    AND NOT EXISTS (SELECT 1 FROM found f WHERE f.doc_id = l.doc_id AND f.s < l.x.s + l.x.n AND l.x.s < f.e)
),
every AS (SELECT * FROM found UNION ALL SELECT * FROM more),
owned AS (SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT (owner, doc_id)) AS repos FROM every GROUP BY 1),
kept AS (SELECT every.*, owners, repos FROM every JOIN owned USING (v) WHERE rank < 3 OR (owners = 1 AND repos < 10)),
agg AS (
    SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans,
        count(*) FILTER (owners = 1 AND repos < 10) AS n_live, count(*) FILTER (owners >= 3 OR repos >= 10) AS n_example, max(repos) AS n_repos
    FROM kept GROUP BY 1
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
    CAST(coalesce(n_repos, 0) AS BIGINT) AS n_repos
FROM doc LEFT JOIN agg USING (doc_id)
"""

RANKED = rf"""
WITH doc AS (SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_all FROM doc WHERE len(w) > 0),
tf AS (SELECT doc_id, t, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS t FROM doc) GROUP BY 1, 2),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY 1), total),
item AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark WHERE item_id IS NOT NULL),
scored AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_all)))) AS BIGINT) AS score
    FROM item JOIN w USING (t) JOIN tf USING (t), total GROUP BY 1, 2
)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50
"""

_SOUND = "label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
HARD_NEGATIVES = f"""
WITH row AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings WHERE vec_id IS NOT NULL AND {_SOUND}
),
pair AS (
    SELECT a.id AS a, a.label = b.label AS same, b.id AS b, CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS s
    FROM row a JOIN row b ON a.id <> b.id AND len(a.q) = len(b.q) WHERE a.id % 100 = 0
),
positive AS (SELECT a, b AS p, s AS ps FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY s DESC, b) AS n FROM pair WHERE same) WHERE n <= 5),
hard AS (SELECT a, p, ps, b, s, row_number() OVER (PARTITION BY a, p ORDER BY s DESC, b) AS n FROM positive JOIN pair USING (a) WHERE NOT same AND 30 * ps <= 100 * s AND 100 * s <= 90 * ps)
SELECT a AS anchor_id, p AS positive_id, CAST(n AS INT) AS rank, b AS negative_id, ps AS positive_score, s AS negative_score FROM hard WHERE n <= 10
"""

ORACLES: dict[str, str] = {"op12_ranked_search": RANKED, "op13_hard_negatives": HARD_NEGATIVES, "op3_secret_scan": SECRETS, "op7_decontaminate": DECONTAMINATE, "op10_line_dedup": LINE_DEDUP}
