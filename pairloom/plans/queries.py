"""Queries over the driver's tables, each with the SQL that gives the same rows.

The part table plays both catalogs (even keys against odd keys), see sources.catalog.part_catalogs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quantity as Q
from ..functions import similarity as M
from ..functions import text as T
from ..operators import blocking, index, report
from ..sources.catalog import part_catalogs, parts
from . import fact_queries, fusion_queries, review_queries, score_queries, verdict_queries
from .stages import shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Features of both catalogs; part names are plain ASCII, so normalising stays in the JVM."""
    a, b = part_catalogs(spark, sf_dir)
    return blocking.features(a, "row_key", False), blocking.features(b, "b_index", False)


def candidate_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = part_catalogs(spark, sf_dir)
    return blocking.retrieve(a, b, unicode=False).select("row_key", "b_index", "item_id_B", "retrieval_rank", "retrieval_score", "protected")


def _stored(spark: SparkSession, sf_dir: str) -> index.Target:
    """The second catalog's tables, stored under a name and a folder of their own."""
    _, b = part_catalogs(spark, sf_dir)
    path = shared_folder(spark)
    return index.build(b, f"parts_{path.rsplit('/', 1)[1]}", path, int(spark.conf.get("spark.sql.shuffle.partitions")), unicode=False)


def index_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the stored tables, with their postings counted in three ways."""
    target = _stored(spark, sf_dir)
    held = target.postings.groupBy("key").agg(F.count("*").alias("held"), F.min("b_index").alias("first"))
    branded = target.branded.groupBy("key").agg(F.count("*").alias("branded"))
    return target.counts.join(held, "key").join(branded, "key", "left").select("key", "n", "held", "first", F.coalesce("branded", F.lit(0)).alias("branded"))


def candidates_from_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """candidate_topk, from stored tables of the second catalog."""
    a, _ = part_catalogs(spark, sf_dir)
    found = blocking.retrieve(a, None, unicode=False, stored=_stored(spark, sf_dir))
    return found.select("row_key", "b_index", "item_id_B", "retrieval_rank", "retrieval_score", "protected")


def streamed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """candidate_topk, with the first catalog arriving in three batches and the second one stored."""
    from ..streaming import arrivals

    a, _ = part_catalogs(spark, sf_dir)
    path = shared_folder(spark)
    a.repartition(3, "row_key").write.parquet(f"{path}/source")
    target = _stored(spark, sf_dir)
    stream = spark.readStream.schema(a.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/source")
    arrivals.arrive(stream, lambda rows: blocking.retrieve(rows, None, unicode=False, stored=target), f"{path}/arrivals").awaitTermination()
    return arrivals.arrived(spark, f"{path}/arrivals").select("row_key", "b_index", "item_id_B", "retrieval_rank", "retrieval_score", "protected")


def norm_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)[0].select("row_key", "title", "brand")


def core_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)[0].select("row_key", F.array_join("core", " ").alias("core"))


def numeric_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)[1].select("b_index", F.array_join("nums", " ").alias("nums"))


def doc_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.token_weights(_features(spark, sf_dir)[1]).select("token", "df", F.round("idf", 9).alias("idf"))


def exact_title_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _features(spark, sf_dir)
    return a.select("row_key", "title").join(b.select("b_index", "title"), "title").select("row_key", "b_index")


def rare_token_top4(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _features(spark, sf_dir)
    tokens = blocking.weighed(a, "row_key", blocking.token_weights(b))
    return tokens.select("row_key", F.array_join(F.transform(blocking.rare_tokens(F.col("tokens"), blocking.RARE), lambda t: t["token"]), " ").alias("rare"))


def number_blocking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that share a number, counted for each row."""
    a, b = _features(spark, sf_dir)
    n = b.select(F.explode("nums").alias("z")).groupBy("z").agg(F.count("*").alias("n"))
    return a.select("row_key", F.explode("nums").alias("z")).join(n, "z").groupBy("row_key").agg(F.sum("n").alias("pairs"))


def pair_token_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarities of the pairs with equal row numbers."""
    a, b = _features(spark, sf_dir)
    pair = a.select("row_key", F.col("core").alias("x")).join(b.select(F.col("b_index").alias("row_key"), F.col("core").alias("y")), "row_key")
    return pair.select("row_key", F.round(M.token_sim(F.col("x"), F.col("y")), 9).alias("token_sim"), F.round(M.jaccard(F.col("x"), F.col("y")), 9).alias("jaccard"))


def numeric_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", (F.col("l_extendedprice") / F.col("l_quantity") / 1000).alias("x"))
    return rows.groupBy(M.numeric_sim(F.col("l_quantity") / 25, F.col("x"), 0.03).alias("sim")).agg(F.count("*").alias("n"))


def quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, _ = part_catalogs(spark, sf_dir)
    size = a.select("row_key", T.norm_text(F.col("name"), False).alias("nt"))
    return size.select("row_key", F.round(Q.first_of(Q.quantities(F.col("nt")), "mass_g"), 6).alias("mass_g"))


def calibrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _table(spark, sf_dir, "lineitem").select("l_discount").distinct()
    return raw.select("l_discount", F.round(M.calibrated(F.col("l_discount") * 10, 6.564689133174299, -5.141619688855791), 9).alias("match"), F.round(M.calibrated(F.col("l_discount") * 10, 8.309152766631854, -3.6557118086781757), 9).alias("nonmatch"))


def profile_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", "lang", "quality", "toxic")
    return report.profile(docs, "doc_id")


def pair_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs' pairs, each customer with many orders, of which the last by date and number counts."""
    orders = _table(spark, sf_dir, "orders")
    pairs = orders.select(F.col("o_custkey").cast("string").alias("item_id_A"), F.col("o_orderpriority").alias("item_id_B"), F.struct("o_orderdate", "o_orderkey").alias("position"), "o_orderkey")
    return report.pair_diff(pairs.where("o_orderkey % 7 <> 0"), pairs.where("o_orderkey % 3 <> 0"))


def override_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows replaced whole by overrides of their key."""
    part = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_key"), "p_brand", "p_size")
    over = part.where("row_key % 5 = 0").select("row_key", F.lit("OVERRIDE").alias("p_brand"), (F.col("p_size") * 2).alias("p_size"))
    return report.with_overrides(part, over)


def reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.histogram(_table(spark, sf_dir, "orders"), "o_orderpriority")


def common_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that 15 % of a brand's parts hold at least."""
    from ..operators import collisions

    rows = _table(spark, sf_dir, "part").select(F.col("p_brand").alias("target"), F.col("p_partkey").alias("row_key"), F.split(F.concat_ws(" ", "p_name", F.lower("p_type")), " ").alias("words"))
    return collisions.common_tokens(rows, 0.15)


def size_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a target whose relative size error is clearly worse than the best."""
    from ..operators import collisions

    part = _table(spark, sf_dir, "part")
    rows = part.select(F.col("p_name").alias("target"), F.col("p_partkey").alias("row_key"), M.relative(F.col("p_size").cast("double"), F.lit(25.0)).alias("err"))
    return collisions.size_preference(rows).where("worse").select("target", "row_key")


def json_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", T.number(F.get_json_object(T.jsonish(F.col("props")), "$.k")).alias("k"))
    return events.groupBy("k").agg(F.count("*").alias("n"))


def deep_shortlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.deep_shortlist(candidate_topk(spark, sf_dir)).select("row_key", "b_index", "retrieval_rank")


def retrieval_floor_stub(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose best candidate scores too low, at a floor that some rows of this table miss."""
    a, _ = part_catalogs(spark, sf_dir)
    return blocking.weak_rows(a, candidate_topk(spark, sf_dir), 4.5)


def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without tags and repeated blanks, as a digest."""
    plain = T.squeeze(F.regexp_replace("html", "<[^>]+>", " "))
    return _table(spark, sf_dir, "pages").select("page_id", F.md5(plain).alias("digest"), F.length(plain).cast("bigint").alias("n_chars"))


def coverage_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each source without a label."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return docs.join(_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti").groupBy("source").agg(F.count("*").alias("n"))


def dimension_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = parts(spark, sf_dir).select("p_partkey", F.concat_ws("", F.col("p_size").cast("string"), F.lit(" x "), (F.col("p_size") + 2).cast("string"), F.lit(" in")).alias("s"))
    return part.select("p_partkey", F.array_join(F.transform(Q.dimensions(F.col("s")), lambda x: F.round(x, 1).cast("string")), "/").alias("mm"))


def pack_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plausible counts of made-up multipack titles."""
    part = parts(spark, sf_dir).select("p_partkey", F.concat_ws("", F.lit("("), (F.col("p_size") % 4 + 2).cast("string"), F.lit(" pack) "), F.col("p_name"), F.lit(" "), (F.col("p_size") + 10).cast("string"), F.lit(" Count")).alias("s"))
    return part.select("p_partkey", F.array_join(F.transform(Q.count_values(F.col("s")), lambda x: x.cast("string")), ",").alias("counts"))


def fact_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known facts of each attribute."""
    from ..operators import facts

    a, _ = part_catalogs(spark, sf_dir)
    return facts.extract(a, "row_key", unicode=False).groupBy("attr").agg(F.count("*").alias("n"))


def link_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole linkage of the two part catalogs."""
    from .link import link

    a, b = part_catalogs(spark, sf_dir)
    return link(a, b, unicode=False).select("row_key", "item_id_A", "selected_item_id_B", "final_verdict", "decision_reason")


def fake_adjudication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a stand-in client to a packet for each nation, kept in a folder."""
    from ..operators import adjudicate

    def client(packets: list[dict]) -> list[dict]:
        return [{"row_key": p["row_key"], "choice": 1, "decision": "MATCH", "match_type": "SAME_BRAND_PRODUCT", "blocker": "NONE", "evidence": "CLEAR"} for p in packets]

    rows = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("row_key"))
    return adjudicate.ask(rows.select("row_key", F.to_json(F.struct("row_key")).alias("payload")), client, shared_folder(spark))


#: Queries that SQL can't express: rules over match places.
ROWS_ONLY = ("fact_counts", "link_verdicts")
QUERIES = {
    f.__name__: f
    for f in (
        candidate_topk, index_postings, candidates_from_index, streamed_candidates, norm_title, core_tokens, numeric_tokens, doc_freq, exact_title_join, rare_token_top4, number_blocking, pair_token_similarity, numeric_similarity, quantities,
        calibrate, profile_blanks, pair_diff, override_merge, reason_histogram, common_tokens, size_preference, json_values,
        deep_shortlist, retrieval_floor_stub, html_strip, coverage_anti_join, dimension_signature, pack_counts, fact_counts, link_verdicts, fake_adjudication,
    )
}

_STOP = ", ".join(f"'{w}'" for w in T.STOP_WORDS)
_PART = f"""
WITH part_rows AS (
    SELECT p_partkey, p_partkey // 2 AS k, p_partkey % 2 AS side, p_name || ' ' || p_type || ' ' || p_size || ' oz' AS name, p_brand,
        '{{"size_user_friendly":"' || p_size || ' oz"}}' AS sizing FROM part
),
norm AS (
    SELECT *, trim(regexp_replace(regexp_replace(lower(name), '[^a-z0-9%+.\\- ]+', ' ', 'g'), '\\s+', ' ', 'g')) AS title,
        trim(regexp_replace(regexp_replace(lower(p_brand), '[^a-z0-9%+.\\- ]+', ' ', 'g'), '\\s+', ' ', 'g')) AS brand,
        trim(regexp_replace(regexp_replace(lower(sizing), '[^a-z0-9%+.\\- ]+', ' ', 'g'), '\\s+', ' ', 'g')) AS size FROM part_rows
),
feat AS (
    SELECT k, side, CAST(p_partkey AS VARCHAR) AS item_id, title, brand,
        list_sort(list_distinct(list_filter(regexp_extract_all(title, '[a-z0-9]+'), lambda w: NOT regexp_full_match(w, '[0-9]+') AND NOT list_contains([{_STOP}], w) AND NOT list_contains(regexp_extract_all(brand, '[a-z0-9]+'), w)))) AS core,
        list_sort(list_distinct(list_concat(
            list_transform(regexp_extract_all(title || ' ' || size, '\\b\\d+(?:\\.\\d+)?(?:\\s*(?:fl\\s*oz|oz|lb|g|kg|mg|mcg|ml|l|ct|count|pk|pack|%))?\\b'), lambda x: regexp_replace(x, '\\s+', '', 'g')),
            list_filter(regexp_extract_all(title || ' ' || size, '[a-z0-9-]+'), lambda w: length(w) BETWEEN 3 AND 24 AND regexp_matches(w, '[a-z]') AND regexp_matches(w, '[0-9]'))))) AS nums
    FROM norm
),
a AS (SELECT * FROM feat WHERE side = 0),
b AS (SELECT * FROM feat WHERE side = 1),
total AS (SELECT count(*) AS n FROM b),
weight AS (SELECT token, df, ln((n + 1) / (df + 1)) + 1 AS idf FROM (SELECT token, count(*) AS df FROM (SELECT unnest(core) AS token FROM b) GROUP BY 1), total),
ranked AS (SELECT k, token, row_number() OVER (PARTITION BY k ORDER BY df, -length(token), token) AS n, idf FROM (SELECT k, unnest(core) AS token FROM a) JOIN weight USING (token))
"""
ORACLES = {
    "norm_title": _PART + "SELECT k AS row_key, title, brand FROM a",
    "core_tokens": _PART + "SELECT k AS row_key, array_to_string(core, ' ') AS core FROM a",
    "numeric_tokens": _PART + "SELECT k AS b_index, array_to_string(nums, ' ') AS nums FROM b",
    "doc_freq": _PART + "SELECT token, df, round(idf, 9) AS idf FROM weight",
    "exact_title_join": _PART + "SELECT a.k AS row_key, b.k AS b_index FROM a JOIN b USING (title)",
    "rare_token_top4": _PART + "SELECT k AS row_key, string_agg(token, ' ' ORDER BY n) AS rare FROM ranked WHERE n <= 4 GROUP BY 1",
    "number_blocking": _PART + "SELECT x.k AS row_key, count(*) AS pairs FROM (SELECT k, unnest(nums) AS z FROM a) x JOIN (SELECT unnest(nums) AS z FROM b) y USING (z) GROUP BY 1",
    "pair_token_similarity": _PART
    + """, p AS (SELECT a.k AS row_key, len(list_intersect(a.core, b.core)) AS i, len(a.core) AS x, len(b.core) AS y FROM a JOIN b USING (k))
    SELECT row_key, round(CASE WHEN x = 0 OR y = 0 THEN 0 ELSE greatest(i / (x + y - i), i / least(x, y) * 0.92) END, 9) AS token_sim, round(CASE WHEN x + y = 0 THEN 0 ELSE i / (x + y - i) END, 9) AS jaccard FROM p""",
    "candidate_topk": _PART
    + """, chan AS (
        SELECT ranked.k AS a, p.k AS b, CAST(round(ranked.idf * 1.8 * 1000000) AS BIGINT) AS w, false AS ex FROM ranked JOIN (SELECT k, unnest(core) AS token FROM b) p USING (token) WHERE ranked.n <= 4
        UNION ALL SELECT x.k, y.k, 1200000, false FROM (SELECT k, unnest(nums) AS z FROM a) x JOIN (SELECT k, unnest(nums) AS z FROM b) y USING (z)
        UNION ALL SELECT a.k, b.k, 10000000, true FROM a JOIN b USING (title)
        UNION ALL SELECT a.k, b.k, CAST(round((1.2 + 0.12 * coalesce((SELECT sum(idf) FROM weight WHERE list_contains(a.core, token) AND list_contains(b.core, token)), 0)) * 1000000) AS BIGINT), false
            FROM a JOIN b USING (brand) WHERE brand <> '' AND (SELECT count(*) FROM b z WHERE z.brand = a.brand) <= 600 AND (len(list_intersect(a.core, b.core)) > 0 OR len(list_intersect(a.nums, b.nums)) > 0)
    ),
    acc AS (SELECT a, b, sum(w) AS w, bool_or(ex) AS ex FROM chan GROUP BY 1, 2),
    pool AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY w DESC, b) AS n FROM acc) WHERE n <= 20),
    mass AS (SELECT side, k, sum(coalesce(idf, 1.0)) AS m FROM (SELECT side, k, unnest(core) AS token FROM feat) LEFT JOIN weight USING (token) GROUP BY 1, 2),
    pair AS (
        SELECT pool.a, pool.b, ex, b.item_id, a.brand = b.brand AND a.brand <> '' AS same, a.title = b.title AS exact, a.nums AS na, b.nums AS nb, coalesce(ma.m, 0) AS aw, coalesce(mb.m, 0) AS bw,
            coalesce((SELECT sum(idf) FROM weight WHERE list_contains(a.core, token) AND list_contains(b.core, token)), 0) AS wi
        FROM pool JOIN a ON a.k = pool.a JOIN b ON b.k = pool.b LEFT JOIN mass ma ON ma.side = 0 AND ma.k = pool.a LEFT JOIN mass mb ON mb.side = 1 AND mb.k = pool.b
    ),
    scored AS (
        SELECT *, 3.2 * wi / CASE WHEN aw + bw - wi = 0 THEN 1 ELSE aw + bw - wi END + 1.8 * wi / least(CASE WHEN aw = 0 THEN 1 ELSE aw END, CASE WHEN bw = 0 THEN 1 ELSE bw END)
            + same::INT + 0.6 * CASE WHEN len(na) > 0 AND na = nb THEN 1.0 WHEN len(list_intersect(na, nb)) > 0 THEN 0.5 ELSE 0 END + 4.0 * exact::INT AS score FROM pair
    )
    SELECT a AS row_key, b AS b_index, item_id AS "item_id_B", CAST(row_number() OVER (PARTITION BY a ORDER BY round(score, 9) DESC, b) AS INT) AS retrieval_rank, round(score, 6) AS retrieval_score, ex AS protected FROM scored""",
    "numeric_similarity": """WITH r AS (SELECT abs(x - y) / greatest(abs(x), abs(y), 1e-9) AS r FROM (SELECT l_quantity / 25 AS x, l_extendedprice / l_quantity / 1000 AS y FROM lineitem))
    SELECT CASE WHEN r <= 0.005 THEN 1.0 WHEN r <= 0.03 THEN 0.90 WHEN r <= 0.10 THEN 0.45 ELSE 0.0 END::DOUBLE AS sim, count(*) AS n FROM r GROUP BY 1""",
    "quantities": "SELECT p_partkey // 2 AS row_key, round(p_size * 28.349523125::DOUBLE, 6) AS mass_g FROM part WHERE p_partkey % 2 = 0",
    "calibrate": "SELECT DISTINCT l_discount, round(1 / (1 + exp(-(l_discount * 10 * 6.564689133174299 - 5.141619688855791))), 9) AS match, round(1 / (1 + exp(-(l_discount * 10 * 8.309152766631854 - 3.6557118086781757))), 9) AS nonmatch FROM lineitem",
    "profile_blanks": """WITH d AS (SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)),
    s AS (SELECT count(*) AS rows, count(DISTINCT doc_id) AS ids, count(*) FILTER (lang IS NULL OR trim(lang) = '') AS l, count(*) FILTER (quality IS NULL) AS q, count(*) FILTER (toxic IS NULL) AS t FROM d)
    SELECT c.column, rows, ids AS unique_ids, rows - ids AS duplicate_ids, c.blank, round(c.blank / rows, 6) AS blank_share
    FROM (SELECT rows, ids, unnest([{'column': 'doc_id', 'blank': 0}, {'column': 'lang', 'blank': l}, {'column': 'quality', 'blank': q}, {'column': 'toxic', 'blank': t}]) AS c FROM s)""",
    "pair_diff": """WITH j AS (
        SELECT x.p AS l, y.p AS r FROM (SELECT o_custkey, arg_max(o_orderpriority, struct_pack(d := o_orderdate, k := o_orderkey)) AS p FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1) x
        FULL JOIN (SELECT o_custkey, arg_max(o_orderpriority, struct_pack(d := o_orderdate, k := o_orderkey)) AS p FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1) y USING (o_custkey)
    )
    SELECT count(*) FILTER (l = r) AS same, count(*) FILTER (l <> r) AS changed, count(*) FILTER (l IS NULL) AS added, count(*) FILTER (r IS NULL) AS removed,
        round(count(*) FILTER (l = r) / (count(l) + count(r) - count(*) FILTER (l = r)), 6) AS jaccard FROM j""",
    "override_merge": "SELECT p_partkey AS row_key, CASE WHEN p_partkey % 5 = 0 THEN 'OVERRIDE' ELSE p_brand END AS p_brand, CASE WHEN p_partkey % 5 = 0 THEN p_size * 2 ELSE p_size END AS p_size FROM part",
    "reason_histogram": "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1",
    "common_tokens": """WITH r AS (SELECT p_brand AS target, p_partkey, unnest(list_distinct(string_split(p_name || ' ' || lower(p_type), ' '))) AS token FROM part), n AS (SELECT p_brand AS target, count(*) AS n FROM part GROUP BY 1)
    SELECT target, token FROM (SELECT target, token, count(*) AS k FROM r GROUP BY 1, 2) JOIN n USING (target) WHERE k / n >= 0.15""",
    "size_preference": """WITH r AS (SELECT p_name AS target, p_partkey AS row_key, abs(p_size - 25.0::DOUBLE) / greatest(p_size, 25) AS err FROM part),
    w AS (SELECT *, count(*) OVER (PARTITION BY target) AS n, min(CASE WHEN err < 0.2 THEN err END) OVER (PARTITION BY target) AS best FROM r)
    SELECT target, row_key FROM w WHERE n >= 2 AND best IS NOT NULL AND err > greatest(0.025, best + 0.012)""",
    "fake_adjudication": """SELECT CAST(n_nationkey AS BIGINT) AS row_key, 1 AS choice, 'MATCH' AS decision, 'SAME_BRAND_PRODUCT' AS match_type, 'NONE' AS blocker, 'CLEAR' AS evidence FROM nation""",
    "json_values": "SELECT CAST(props->>'$.k' AS DOUBLE) AS k, count(*) AS n FROM events GROUP BY 1",
}
_TOP = ORACLES["candidate_topk"]
ORACLES |= {
    "candidates_from_index": _TOP,
    "streamed_candidates": _TOP,
    "index_postings": _PART
    + """, keyed AS (SELECT k, brand, 't:' || unnest(core) AS key FROM b UNION ALL SELECT k, brand, 'n:' || unnest(nums) FROM b)
    SELECT key, count(*) AS n, count(*) AS held, min(k) AS first, count(*) FILTER (brand <> '') AS branded FROM keyed GROUP BY 1""",
    "deep_shortlist": f"""SELECT row_key, b_index, retrieval_rank FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY retrieval_rank) AS p FROM ({_TOP}) WHERE retrieval_rank <= 3 OR protected) WHERE p <= 5""",
    "retrieval_floor_stub": f"""SELECT p_partkey // 2 AS row_key, CAST(p_partkey AS VARCHAR) AS item_id, 'WEAK_RETRIEVAL_NONMATCH' AS decision_reason FROM part
    WHERE p_partkey % 2 = 0 AND p_partkey // 2 NOT IN (SELECT row_key FROM ({_TOP}) WHERE retrieval_rank = 1 AND retrieval_score >= 4.5)""",
    "html_strip": "SELECT page_id, md5(t) AS digest, length(t) AS n_chars FROM (SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS t FROM pages)",
    "coverage_anti_join": "SELECT source, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1",
    "dimension_signature": "SELECT p_partkey, CAST(round(p_size * 25.4::DOUBLE, 1) AS VARCHAR) || '/' || CAST(round((p_size + 2) * 25.4::DOUBLE, 1) AS VARCHAR) AS mm FROM part",
    "pack_counts": """SELECT p_partkey, array_to_string(list_sort(list_distinct([p_size % 4 + 2, p_size + 10] || CASE WHEN p_size % 4 + 2 <> p_size + 10 THEN [(p_size % 4 + 2) * (p_size + 10)] ELSE [] END)), ',') AS counts FROM part""",
}

for _more in (verdict_queries, fact_queries, score_queries, review_queries):
    QUERIES |= _more.QUERIES
    ORACLES |= _more.ORACLES
QUERIES |= fusion_queries.QUERIES
ORACLES |= fusion_queries.oracles(_PART)
