"""Queries over scored pairs made from the line items, and over made-up titles, each with its SQL.

An order is a row of the first catalog and its lines are its candidates; scores and flags are made from their keys, so that every lane is met.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import quantity as Q
from ..functions import similarity as M
from ..operators import certify, collisions, nets, report, routing
from ..sources.catalog import parts

#: Columns of the pairs, in a form that both engines read.
_PAIRS = """
SELECT l_orderkey AS row_key, l_linenumber AS retrieval_rank, CAST(l_partkey AS {text}) AS item_id_B,
    CAST((l_partkey * 7 + l_linenumber * 13) % 101 AS DOUBLE) / CAST(100 AS DOUBLE) AS match_evidence_score,
    CAST((l_suppkey * 11 + l_linenumber * 5) % 97 AS DOUBLE) / CAST(150 AS DOUBLE) AS nonmatch_evidence_score,
    (l_partkey + l_linenumber) % 11 = 0 AS hard_veto,
    CAST(30 + (l_partkey * 3 + l_suppkey) % 71 AS DOUBLE) / CAST(100 AS DOUBLE) AS functional_identity_similarity,
    l_partkey % 6 AS atomic_positive_evidence_count, l_suppkey % 4 AS identity_anchor_count,
    CASE (l_partkey + l_suppkey) % 6 WHEN 0 THEN 'SAME' WHEN 1 THEN 'SAME_INFERRED' WHEN 2 THEN 'PRIVATE' WHEN 3 THEN 'COMMODITY' WHEN 4 THEN 'CONFLICT' ELSE 'UNKNOWN' END AS brand_policy,
    CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END AS modifier_asymmetry_count,
    CASE l_suppkey % 4 WHEN 0 THEN CAST(-1 AS DOUBLE) WHEN 1 THEN CAST(0.5 AS DOUBLE) WHEN 2 THEN CAST(0.8 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS quantity_similarity,
    (l_partkey + l_suppkey) % 6 = 0 AS same_brand, (l_partkey + l_suppkey) % 6 = 2 AS private_label_pair, l_partkey % 17 = 0 AS exact_title_match
FROM {lineitem}"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return spark.sql(_PAIRS.format(text="STRING", lineitem="{lineitem}"), lineitem=lineitem)


def best_and_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best candidate of each row with its margin over the runner-up."""
    p = routing.best_and_margin(routing.supported(scored(spark, sf_dir), routing.Thresholds()))
    return p.select("row_key", "item_id_B", "runner_up_item_id_B", F.round("automatic_support_score", 9).alias("support"), F.round("runner_up_margin", 9).alias("margin"), "candidate_count", "all_veto")


def calibrated_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = routing.supported(scored(spark, sf_dir), routing.Thresholds())
    return p.groupBy("match_evidence_score", "nonmatch_evidence_score", "hard_veto").agg(F.count("*").alias("n"), *[F.round(F.max(c), 9).alias(c) for c in ("match_confidence", "nonmatch_confidence", "pair_support_score", "automatic_support_score")])


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict, reason and guess of each row."""
    return routing.route(scored(spark, sf_dir)).select("row_key", "item_id_B", "final_verdict", "decision_reason", "educated_guess")


def rows_with_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.with_context(routing.route(scored(spark, sf_dir))).select("row_key", "final_verdict")


def route_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.histogram(routing.route(scored(spark, sf_dir)), "final_verdict")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.summary(routing.route(scored(spark, sf_dir)), 300)


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.route(scored(spark, sf_dir)).withColumn("batch", F.col("row_key") % 8)


def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows under review by priority: the best of each batch, then the best of all."""
    return report.review_queue(_queue(spark, sf_dir), 25, 120, "batch").select("row_key", "batch", "priority")


def _demoted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    v = routing.route(scored(spark, sf_dir)).withColumn("selected_item_id_B", F.when(F.col("final_verdict") == "MATCH", F.col("item_id_B")).otherwise(""))
    v = v.withColumn("final_safety_blocker", F.lit("")).withColumn("manual_review_required", F.col("final_verdict") == "REVIEW")
    v = v.withColumn("item_id_A", F.col("row_key").cast("string")).withColumn("name_A", F.concat(F.lit("a "), "item_id_A")).withColumn("name_B", F.concat(F.lit("b "), "item_id_B"))
    return v, v.where("row_key % 3 = 0").select("row_key", F.concat(F.lit("REASON_"), (F.col("row_key") % 5).cast("string")).alias("reason"))


def demoted_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts after some matches were sent back to review."""
    return certify.demoted(*_demoted(spark, sf_dir)).select("row_key", "final_verdict", "selected_item_id_B", "final_safety_blocker", "manual_review_required")


def demotion_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return certify.audit(*_demoted(spark, sf_dir))


def single_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of an id and others whose name contains it."""
    part = parts(spark, sf_dir).select(F.col("p_partkey").cast("string").alias("item_id"), F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("name"))
    return report.lookup(part, "17")


def net_size_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy clusters of sizes within 8 %, in row order."""
    part = parts(spark, sf_dir).select(F.col("p_brand").alias("target"), F.col("p_partkey").alias("row_key"), F.col("p_size").alias("value"))
    return certify.near_clusters(part)


#: Titles of both sides, and the number in them, from a part's keys.
_TITLES = """
SELECT p_partkey, p_size % 5 + 2 AS n, p_size + 7 AS m, p_partkey % 4 AS form,
    CASE p_partkey % 4 WHEN 0 THEN concat('(', CAST(p_size % 5 + 2 AS {text}), ' pack) soap ', CAST(p_size + 7 AS {text}), ' count') WHEN 1 THEN concat('Towels ', CAST(p_size % 5 + 2 AS {text}), ' mega rolls')
        WHEN 2 THEN concat('Tea, pack of ', CAST(p_size % 5 + 2 AS {text})) ELSE concat('Wipes ', CAST(p_size % 5 + 2 AS {text}), ' packs of ', CAST(p_size + 7 AS {text}), ' wipes') END AS a,
    CASE p_partkey % 4 WHEN 0 THEN concat('Soap ', CAST(p_size + 7 AS {text}), ' ct') WHEN 1 THEN concat('Towels ', CAST(p_size % 5 + 2 AS {text}), ' double rolls')
        WHEN 2 THEN concat('Tea ', CAST(p_size + 7 AS {text}), ' count') ELSE 'Wipes' END AS b
FROM {part}"""


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_TITLES.format(text="STRING", part="{part}"), part=parts(spark, sf_dir))


def pack_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of two titles and whether they clash."""
    t, a, b = _titles(spark, sf_dir), F.col("a"), F.col("b")
    joined = lambda x: F.array_join(F.transform(x, lambda v: v.cast("string")), ",")
    return t.select(
        "p_partkey", joined(Q.count_values(a)).alias("counts_a"), joined(Q.count_values(b)).alias("counts_b"), Q.pack_total(a).alias("total_a"), Q.pack_total(b).alias("total_b"),
        Q.roll_tier(F.lower(a)).alias("tier_a"), Q.roll_tier(F.lower(b)).alias("tier_b"), Q.one_sided_count(a, b).alias("one_sided"), Q.pack_conflict(a, b, F.lower(a), F.lower(b)).alias("conflict"),
        Q.leading_multipack(a).alias("lead"), Q.explicit_total_count(a).alias("explicit"), certify.package_count(a).alias("package"),
    )


def amount_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity, nearness and related brands of made-up amounts and names."""
    part = parts(spark, sf_dir).select("p_partkey", F.col("p_size").cast("double").alias("x"), (F.col("p_partkey") % 50 + 1).cast("double").alias("y"), F.split("p_name", " ").alias("w"))
    x, y, w = F.col("x"), F.col("y"), F.col("w")
    other = F.array(F.col("w")[0], F.lit("foods"), F.col("w")[1], F.when(F.col("p_partkey") % 2 == 0, F.lit("zzz")).otherwise(F.lit("inc")))
    near = M.near_any(F.array(x, x * 2), F.array(y), 0.05)
    return part.select("p_partkey", M.numeric_sim(x, y).alias("sim"), M.numeric_value(F.col("p_partkey") % 2, F.lit(0), x, y).alias("value_sim"), near.alias("near"), M.related_brands(F.array_append(w, "co"), other).alias("related"))


#: Titles of six forms, from a part's key and size.
_NET_TITLES = """
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN concat('(', n, ' pack) cola ', m, ' fl oz') WHEN 1 THEN concat('Photo paper ', n, ' x ', m, ' sheet ', n, ' oz') WHEN 2 THEN concat('Soda ', m, ' fl oz, ', n, ' bottles')
    WHEN 3 THEN concat(n, ' x ', m, ' g soap') WHEN 4 THEN concat('Bar ', m, 'g protein ', n, ' oz') ELSE concat(p_name, ' ', n, ' count') END AS t
FROM (SELECT p_partkey, p_name, CAST(p_size % 7 + 2 AS STRING) AS n, CAST(p_size + 9 AS STRING) AS m FROM {part})"""


def package_nets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net contents of made-up titles: outer packs, counted containers, and numbers that multiply nothing."""
    rows = spark.sql(_NET_TITLES, part=parts(spark, sf_dir))
    found = nets.with_net(rows, "net", F.col("t"), certify.package_count(F.col("t")))
    return found.select("p_partkey", "net.dim", F.round("net.total", 6).alias("total"), F.round("net.shown", 6).alias("shown"), "net.mode")


#: Matches of five kinds, two parts to a target: alone with a count the target lacks, the same beside a fitting one, a size twice the target's, a bowl for a bag, a size four percent off beside a fitting one.
_MERGES = """
SELECT row_key, CAST(pair AS STRING) AS target, 'acme' AS brand_B, '' AS description_B, '' AS info_B, CASE kind WHEN 4 THEN 'COMMODITY' ELSE 'PRIVATE' END AS brand_policy,
    CASE kind WHEN 0 THEN '6 packs of 20 wipes' WHEN 1 THEN CASE WHEN odd THEN '6 packs of 40 wipes' ELSE '6 packs of 20 wipes' END WHEN 2 THEN concat('Lotion ', s, ' oz') WHEN 3 THEN 'Salad bowl'
        ELSE CASE WHEN odd THEN concat('Tea ', s, '00 g') ELSE concat('Tea ', s, '04 g') END END AS name_A,
    CASE kind WHEN 0 THEN '6 packs of 40 wipes' WHEN 1 THEN '6 packs of 40 wipes' WHEN 2 THEN 'Lotion' WHEN 3 THEN 'Salad bag' ELSE 'Tea' END AS name_B,
    CASE kind WHEN 2 THEN concat(CAST(s * 2 AS STRING), ' oz') WHEN 4 THEN concat(s, '00 g') ELSE '' END AS size_B
FROM (SELECT p_partkey AS row_key, p_partkey DIV 2 AS pair, p_partkey DIV 2 % 5 AS kind, p_partkey % 2 = 1 AS odd, 1 AS s FROM {part}) WHERE kind <> 0 OR NOT odd"""


def merge_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why made-up matches of a target can't all be right, by the merge checks."""
    rows = spark.sql(_MERGES, part=parts(spark, sf_dir))
    return collisions.demotions(rows).select("row_key", "reason")


def last_check_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons of the last check against made-up matches of every phrase with every other."""
    return certify.judged(spark.sql(_CASES)).select("row_key", "reason")


_PHRASES = (
    "unsweetened tea", "hot and spicy sauce", "maple sausage", "mushroom alfredo", "green tea", "lemon ginger", "fresh dentastix", "original dentastix", "stitch cup", "moana cup", "pine wonderland", "single serve packet",
    "jar", "whitening protection", "reduced sodium soup", "buttermilk ranch", "classic ranch", "deep conditioner", "cool mint gum", "spearmint gum", "tan nasal strips", "clear nasal strips", "pear halves", "sliced pear", "fat free milk",
)
_VALUES = ", ".join(f"({i}, '{p}')" for i, p in enumerate(_PHRASES))
_POLICIES = "(0, 'SAME'), (1, 'PRIVATE'), (2, 'COMMODITY')"
_CASES = f"""
SELECT CAST(x.i * 1000 + y.i * 10 + p.i AS BIGINT) AS row_key, 't' AS target, x.t AS name_A, y.t AS name_B, '' AS description_B, '' AS info_B, '' AS size_B, p.t AS brand_policy
FROM (VALUES {_VALUES}) AS x(i, t) CROSS JOIN (VALUES {_VALUES}) AS y(i, t) CROSS JOIN (VALUES {_POLICIES}) AS p(i, t)"""


def _sql_says(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, '{certify.word_pattern(pattern)}')"


def _sql_rule(rule: certify.Rule) -> str:
    tests = [_sql_says("name_A", p) for p in rule.says]
    tests += [f"NOT {_sql_says('name_B', rule.lacks)}"] if rule.lacks else []
    tests += [_sql_says("name_B", rule.names)] if rule.names else []
    tests += [_sql_says("(name_A || ' ' || name_B)", rule.either)] if rule.either else []
    return f"WHEN {' AND '.join(tests)} THEN '{rule.code}'"


def _sql_apart(groups: tuple[tuple[str, ...], ...], words: bool) -> str:
    def held(column: str) -> str:
        one = lambda g: _sql_says(column, "|".join(g)) if words else f"contains(lower({column}), '{g[0]}')"
        return "list_filter([" + ", ".join(f"CASE WHEN {one(g)} THEN {i} END" for i, g in enumerate(groups)) + "], lambda v: v IS NOT NULL)"

    a, b = held("name_A"), held("name_B")
    return f"len({a}) > 0 AND len({b}) > 0 AND len(list_intersect({a}, {b})) = 0"


_REASONS = f"""SELECT row_key, CASE
    WHEN brand_policy = 'SAME' THEN CASE {" ".join(map(_sql_rule, certify.NATIONAL))} WHEN {_sql_apart(tuple((m,) for m in certify.MINTS), False)} THEN '{certify.MINT}' {" ".join(map(_sql_rule, certify.COLOR))} END
    WHEN brand_policy = 'PRIVATE' THEN CASE WHEN {_sql_apart(certify.CUTS, True)} AND {_sql_says("(name_A || ' ' || name_B)", certify.CUT_FOODS)} THEN '{certify.CUT}' {" ".join(map(_sql_rule, certify.PRIVATE))} END
END AS reason FROM ({_CASES})"""

_SIGMOID = "CASE WHEN {z} >= 0 THEN 1 / (1 + exp(-({z}))) ELSE exp({z}) / (1 + exp({z})) END"
_MATCH = _SIGMOID.format(z="match_evidence_score * 6.564689133174299::DOUBLE + -5.141619688855791::DOUBLE")
_NONMATCH = _SIGMOID.format(z="nonmatch_evidence_score * 8.309152766631854::DOUBLE + -3.6557118086781757::DOUBLE")
_SUPPORTED = f"""
WITH pairs AS ({_PAIRS.format(text="VARCHAR", lineitem="lineitem")}),
conf AS (SELECT *, {_MATCH} AS match_confidence, {_NONMATCH} AS nonmatch_confidence, 1 / (1 + exp(3.6557118086781757::DOUBLE)) AS floor FROM pairs),
sup AS (SELECT *, match_confidence * (1 - greatest(0, least(1, (nonmatch_confidence - floor) / (1 - floor)))) AS pair_support_score FROM conf),
supported AS (SELECT *, CASE WHEN hard_veto THEN 0 ELSE pair_support_score END AS automatic_support_score FROM sup),
ranked AS (
    SELECT *, row_number() OVER w AS pos, coalesce(lead(item_id_B) OVER w, '') AS runner_up_item_id_B, automatic_support_score - coalesce(lead(automatic_support_score) OVER w, 0) AS margin,
        count(*) OVER (PARTITION BY row_key) AS candidate_count, bool_and(hard_veto) OVER (PARTITION BY row_key) AS all_veto
    FROM supported WINDOW w AS (PARTITION BY row_key ORDER BY automatic_support_score DESC, retrieval_rank, item_id_B)
),
best AS (SELECT * FROM ranked WHERE pos = 1)
"""
_ROUTED = (
    _SUPPORTED
    + """, flags AS (
    SELECT *, match_evidence_score AS raw, functional_identity_similarity AS fs, pair_support_score AS ps, nonmatch_confidence AS nm, quantity_similarity >= 0 AS known, modifier_asymmetry_count = 0 AS clean,
        quantity_similarity < 0 OR quantity_similarity >= 0.72 AS fine, brand_policy IN ('SAME', 'SAME_INFERRED') AS same, brand_policy IN ('SAME', 'SAME_INFERRED', 'PRIVATE', 'COMMODITY') AS brand_ok FROM best
),
lanes AS (
    SELECT *, NOT hard_veto AND brand_policy <> 'CONFLICT' AND nm <= 0.35 AND (
        (exact_title_match AND brand_ok AND clean AND fine)
        OR (retrieval_rank = 1 AND fine AND clean AND identity_anchor_count >= 2 AND (
            (same AND raw >= 0.52 AND fs >= 0.82 AND ps >= 0.10 AND margin >= 0.01 AND atomic_positive_evidence_count >= 3 AND (known OR (raw >= 0.60 AND fs >= 0.90 AND margin >= 0.03 AND atomic_positive_evidence_count >= 4)))
            OR (private_label_pair AND raw >= 0.52 AND fs >= 0.88 AND ps >= 0.10 AND margin >= 0.015 AND atomic_positive_evidence_count >= 3 AND (known OR (raw >= 0.58 AND fs >= 0.92 AND margin >= 0.03)))
            OR (brand_policy = 'COMMODITY' AND raw >= 0.68 AND fs >= 0.90 AND ps >= 0.20 AND margin >= 0.03 AND atomic_positive_evidence_count >= 4)))) AS lane
    FROM flags
),
reasons AS (
    SELECT *, CASE WHEN lane THEN 'AGGRESSIVE_MATCH_LANE'
        WHEN all_veto OR hard_veto OR brand_policy = 'CONFLICT' OR nm >= 0.70 OR raw < 0.40 OR ps < 0.055 OR fs < 0.38 THEN 'CLEAR_NONMATCH'
        WHEN raw BETWEEN 0.46 AND 0.78 AND fs >= 0.52 AND ps >= 0.08 AND (retrieval_rank <= 3 OR margin >= 0.04) THEN 'NARROW_DECISION_BAND'
        WHEN brand_ok AND retrieval_rank = 1 AND raw >= 0.62 AND fs >= 0.88 AND margin >= 0.03 AND known AND fine AND nm < 0.35 AND clean THEN 'BEST_EVIDENCE_MATCH'
        ELSE 'BEST_EVIDENCE_NONMATCH' END AS decision_reason FROM lanes
),
routed AS (
    SELECT *, CASE WHEN decision_reason IN ('AGGRESSIVE_MATCH_LANE', 'BEST_EVIDENCE_MATCH') THEN 'MATCH' WHEN decision_reason = 'NARROW_DECISION_BAND' THEN 'REVIEW' ELSE 'NON_MATCH' END AS final_verdict,
        CASE WHEN NOT hard_veto AND ps >= 0.10 AND fs >= 0.50 THEN 'MATCH' ELSE 'NON_MATCH' END AS educated_guess FROM reasons
)
"""
)
_TITLED = f"WITH t AS ({_TITLES.format(text='VARCHAR', part='part')})"
QUERIES = {
    f.__name__: f
    for f in (
        best_and_margin, calibrated_support, routed, rows_with_context, route_histogram, run_summary, review_queue, demoted_matches, demotion_audit, single_lookup, net_size_clusters, pack_relations, amount_relations, last_check_reasons,
        package_nets, merge_reasons,
    )
}
ORACLES = {
    "best_and_margin": _SUPPORTED + 'SELECT row_key, item_id_B AS "item_id_B", runner_up_item_id_B AS "runner_up_item_id_B", round(automatic_support_score, 9) AS support, round(margin, 9) AS margin, candidate_count, all_veto FROM best',
    "calibrated_support": _SUPPORTED
    + """SELECT match_evidence_score, nonmatch_evidence_score, hard_veto, count(*) AS n, round(max(match_confidence), 9) AS match_confidence, round(max(nonmatch_confidence), 9) AS nonmatch_confidence,
        round(max(pair_support_score), 9) AS pair_support_score, round(max(automatic_support_score), 9) AS automatic_support_score FROM supported GROUP BY 1, 2, 3""",
    "routed": _ROUTED + 'SELECT row_key, item_id_B AS "item_id_B", final_verdict, decision_reason, educated_guess FROM routed',
    "rows_with_context": _ROUTED + "SELECT row_key, final_verdict FROM routed WHERE final_verdict = 'REVIEW' OR (NOT hard_veto AND brand_ok AND nm < 0.35 AND ps >= 0.055 AND retrieval_rank <= 3)",
    "route_histogram": _ROUTED + "SELECT final_verdict, count(*) AS n FROM routed GROUP BY 1",
    "run_summary": _ROUTED
    + """SELECT count(*) AS rows, count(*) FILTER (final_verdict = 'MATCH') AS matches, count(*) FILTER (final_verdict = 'REVIEW') AS reviews, count(*) FILTER (final_verdict = 'NON_MATCH') AS non_matches,
        count(*) FILTER (final_verdict = 'MATCH') >= 300 AS enough FROM routed""",
    "review_queue": _ROUTED
    + """, q AS (
        SELECT row_key, row_key % 8 AS batch, round(ps + 0.35::DOUBLE * raw + 0.22::DOUBLE * fs - 0.25::DOUBLE * nm + (0.08::DOUBLE + CASE WHEN brand_policy = 'PRIVATE' THEN 0.06::DOUBLE ELSE 0::DOUBLE END), 9) AS priority FROM routed
        WHERE final_verdict = 'REVIEW' AND NOT hard_veto AND brand_ok AND NOT (quantity_similarity > 0 AND quantity_similarity < 0.72) AND nm < 0.35 AND ps >= 0.055 AND fs >= 0.48
    ),
    n AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY priority DESC, CAST(row_key AS VARCHAR) DESC) AS k FROM q)
    SELECT row_key, batch, priority FROM n WHERE k <= 25 ORDER BY priority DESC, CAST(row_key AS VARCHAR) DESC LIMIT 120""",
    "demoted_matches": _ROUTED
    + """, d AS (SELECT *, final_verdict = 'MATCH' AND row_key % 3 = 0 AS hit FROM routed)
    SELECT row_key, CASE WHEN hit THEN 'REVIEW' ELSE final_verdict END AS final_verdict, CASE WHEN final_verdict = 'MATCH' AND NOT hit THEN item_id_B ELSE '' END AS "selected_item_id_B",
        CASE WHEN hit THEN 'REASON_' || (row_key % 5) ELSE '' END AS final_safety_blocker, hit OR final_verdict = 'REVIEW' AS manual_review_required FROM d""",
    "demotion_audit": _ROUTED
    + """SELECT CAST(row_key AS VARCHAR) AS "item_id_A", item_id_B AS "item_id_B", 'a ' || row_key AS "name_A", 'b ' || item_id_B AS "name_B", 'REASON_' || (row_key % 5) AS reason, decision_reason AS prior_decision_reason
    FROM routed WHERE final_verdict = 'MATCH' AND row_key % 3 = 0""",
    "single_lookup": """SELECT item_id, name FROM (SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name || ' ' || p_size AS name FROM part) WHERE item_id = '17' OR contains(lower(name), '17')
    ORDER BY (item_id = '17') DESC, item_id LIMIT 10""",
    "net_size_clusters": """WITH RECURSIVE r AS (SELECT p_brand AS target, p_partkey AS row_key, CAST(p_size AS DOUBLE) AS value, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part),
    walk AS (
        SELECT target, row_key, n, [value] AS firsts, 0 AS cluster FROM r WHERE n = 1
        UNION ALL
        SELECT target, row_key, n, CASE WHEN hit IS NULL THEN list_append(firsts, value) ELSE firsts END, CAST(coalesce(hit, len(firsts)) AS INTEGER)
        FROM (
            SELECT r.target, r.row_key, r.n, r.value, w.firsts, list_position(list_transform(w.firsts, lambda x: abs(r.value - x) <= 0.08 * greatest(abs(r.value), abs(x), 1e-9)), true) - 1 AS hit
            FROM walk w JOIN r ON r.target = w.target AND r.n = w.n + 1
        )
    )
    SELECT target, row_key, cluster FROM walk""",
    "package_nets": """WITH f AS (SELECT p_partkey, p_partkey % 6 AS form, p_size % 7 + 2 AS n, p_size + 9 AS m FROM part)
    SELECT p_partkey, CASE WHEN form IN (0, 2) THEN 'vol' WHEN form IN (1, 3, 4) THEN 'mass' END AS dim,
        round(CASE form WHEN 0 THEN n * m * 29.5735295625::DOUBLE WHEN 1 THEN n * 28.349523125::DOUBLE WHEN 2 THEN n * m * 29.5735295625::DOUBLE WHEN 3 THEN n * m WHEN 4 THEN n * 28.349523125::DOUBLE END, 6) AS total,
        round(CASE form WHEN 0 THEN m * 29.5735295625::DOUBLE WHEN 1 THEN n * 28.349523125::DOUBLE WHEN 2 THEN m * 29.5735295625::DOUBLE WHEN 3 THEN m WHEN 4 THEN n * 28.349523125::DOUBLE END, 6) AS shown,
        CASE form WHEN 0 THEN 'mult' WHEN 1 THEN 'package' WHEN 2 THEN 'perunit' WHEN 3 THEN 'mult' WHEN 4 THEN 'package' END AS mode FROM f""",
    "merge_reasons": """WITH f AS (SELECT p_partkey AS row_key, p_partkey // 2 % 5 AS kind, p_partkey % 2 = 1 AS odd FROM part)
    SELECT row_key, CASE kind WHEN 1 THEN 'V17_COLLISION_GENERAL_COUNT' WHEN 2 THEN 'B_METADATA_SIZE' WHEN 3 THEN 'B_METADATA_ROLE' ELSE 'B_COLLISION_BEST_STRUCTURED_SIZE' END AS reason
    FROM f WHERE kind IN (2, 3) OR (kind IN (1, 4) AND NOT odd)""",
    "pack_relations": _TITLED
    + """, c AS (
        SELECT *, CASE form WHEN 0 THEN list_sort(list_distinct([n, m, n * m])) WHEN 1 THEN [n] WHEN 2 THEN [n] ELSE [m] END AS ca, CASE form WHEN 0 THEN [m] WHEN 1 THEN [n] WHEN 2 THEN [m] ELSE [] END AS cb FROM t
    )
    SELECT p_partkey, array_to_string(ca, ',') AS counts_a, array_to_string(cb, ',') AS counts_b, CAST(CASE form WHEN 0 THEN m WHEN 2 THEN n END AS BIGINT) AS total_a, CAST(CASE WHEN form IN (0, 2) THEN m END AS BIGINT) AS total_b,
        CASE WHEN form = 1 THEN 'mega' ELSE '' END AS tier_a, CASE WHEN form = 1 THEN 'double' ELSE '' END AS tier_b, form = 3 AS one_sided, form IN (1, 2) AS conflict, CAST(CASE WHEN form <> 1 THEN n END AS BIGINT) AS lead,
        CAST(CASE WHEN form = 3 THEN n * m END AS BIGINT) AS explicit, CAST(CASE form WHEN 0 THEN m WHEN 1 THEN NULL ELSE n END AS BIGINT) AS package FROM c""",
    "amount_relations": """WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, CAST(p_partkey % 50 + 1 AS DOUBLE) AS y, string_split(p_name, ' ') AS w FROM part),
    s AS (SELECT *, abs(x - y) / greatest(abs(x), abs(y), 1e-9) AS r FROM p),
    v AS (SELECT *, CASE WHEN r <= 0.005 THEN 1.0 WHEN r <= 0.03 THEN 0.90 WHEN r <= 0.10 THEN 0.45 ELSE 0.0 END::DOUBLE AS sim FROM s)
    SELECT p_partkey, sim, CASE WHEN p_partkey % 2 = 0 THEN sim END AS value_sim, abs(x - y) <= 0.05::DOUBLE * greatest(x, y) OR abs(2 * x - y) <= 0.05::DOUBLE * greatest(2 * x, y) AS near,
        len(list_intersect(w, [w[1], w[2]])) >= 0.6 * least(len(list_distinct(w)), CASE WHEN p_partkey % 2 = 0 THEN 3 ELSE 2 END) AS related FROM v""",
    "last_check_reasons": _REASONS,
}
