"""Evidence scores of made-up facts, with the SQL that computes them step by step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import facts, scoring
from ..sources.catalog import parts

QUALITY = {"brand": 0.98, "brand_type": 1.0, "product_family": 0.82, "functional_name": 0.88, "net_weight": 0.94, "declared_count": 0.96, "flavor": 0.94, "product_line": 0.86, "meat_species": 0.94}
_COLUMNS = "row_key match_evidence_score nonmatch_evidence_score functional_identity_similarity atomic_positive_evidence_count identity_anchor_count strong_support_count atomic_conflict_count hard_veto rules asymmetries brand_policy same_brand exact_title_match".split()


def _side(spark: SparkSession, sf_dir: str, key: str, values: dict[str, tuple[str, Column]]) -> DataFrame:
    blank = {"num": "double", "txt": "string", "flag": "boolean", "toks": "array<string>", "nums": "array<double>", "dim": "string"}
    one = [
        F.when(v.isNotNull(), F.struct(F.lit(a).alias("attr"), *[(v if kind == n else F.lit(None)).cast(t).alias(n) for n, t in blank.items()], F.lit(QUALITY[a]).alias("quality"), F.lit("title_family_rules").alias("source")).cast(facts.FACT))
        for a, (kind, v) in values.items()
    ]
    part = parts(spark, sf_dir).withColumn("k", F.col("p_partkey"))
    return part.select(F.col("k").alias(key), F.explode(F.array_compact(F.array(*one))).alias("f")).select(key, "f.*")


def evidence_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores, counts, vetoes, asymmetries and brand policy of a pair for each part; its key and size say which facts agree."""
    k, words = F.col("p_partkey"), lambda *w: F.array(*[F.lit(x) for x in w])
    shared = {
        "brand_type": ("txt", F.when(k % 5 == 0, "private_label").otherwise("national_or_manufacturer")), "product_family": ("txt", F.when(k % 8 == 0, "baby").otherwise("food")),
        "product_line": ("toks", words("ultra")), "meat_species": ("toks", words("beef")),
    }
    size, count = F.col("p_size").cast("double"), (F.col("p_size") % 7 + 2).cast("double")
    name = F.when(k % 4 == 0, words("x", "y", "z")).when(k % 4 == 1, words("w", "x", "y")).when(k % 4 == 2, words("u", "v")).otherwise(words("x", "y"))
    a = {**shared, "brand": ("txt", F.lit("acme")), "functional_name": ("toks", words("x", "y", "z")), "net_weight": ("num", size), "declared_count": ("num", count), "flavor": ("toks", words("mint"))}
    b = {
        **shared, "brand": ("txt", F.when(k % 3 == 0, "zeta").otherwise("acme")), "functional_name": ("toks", name), "net_weight": ("num", size * F.when(k % 7 < 3, 1.0).when(k % 7 < 5, 1.02).otherwise(1.2)),
        "declared_count": ("num", count + F.when(k % 11 == 0, 3).otherwise(0)), "flavor": ("toks", F.when(k % 6 < 3, words("mint")).when(k % 6 == 3, words("lime"))),
    }
    pairs = parts(spark, sf_dir).select(k.alias("row_key"), k.alias("b_index"), F.lit("Plain Thing").alias("name_A"), F.when(k % 7 == 0, "plain  thing").otherwise("other thing").alias("name_B"))
    got = scoring.score_pairs(pairs, _side(spark, sf_dir, "row_key", a), _side(spark, sf_dir, "b_index", b))
    return got.withColumn("rules", F.array_join("hard_veto_rules", ",")).withColumn("asymmetries", F.array_join("modifier_asymmetries", ",")).select(*_COLUMNS)


_EVIDENCE = """
WITH p AS (
    SELECT p_partkey AS k, p_size % 7 + 2 AS c, p_partkey % 5 = 0 AS private, p_partkey % 8 <> 0 AS food,
        CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 0.92::DOUBLE * 2 / 3 WHEN 2 THEN 0 ELSE 0.92 END::DOUBLE AS fs,
        CASE WHEN p_partkey % 7 < 3 THEN 1 WHEN p_partkey % 7 < 5 THEN 0.9 ELSE 0 END::DOUBLE AS weight_sim, p_partkey % 11 = 0 AS counts_differ, p_partkey % 3 = 0 AS brands_differ, p_partkey % 6 AS taste FROM part
),
atoms AS (
    SELECT k, 'brand' AS attr, 'identity' AS grp, 'brand_identity' AS cluster, 7::DOUBLE AS w, 7::DOUBLE AS capped, 0.98::DOUBLE AS q, CASE WHEN brands_differ THEN 0 ELSE 1 END::DOUBLE AS sim, 0.70::DOUBLE AS th,
        CASE WHEN brands_differ AND NOT private THEN 1 END::DOUBLE AS severity, 'V002' AS rule FROM p
    UNION ALL SELECT k, 'product_line', 'identity', 'brand_identity', 3.5, 3.5, 0.86, 1, 0.70, NULL, NULL FROM p
    UNION ALL SELECT k, 'brand_type', 'identity', 'brand_type', 1.5, 1.5, 1.0, 1, 0.70, NULL, NULL FROM p
    UNION ALL SELECT k, 'product_family', 'identity', 'broad', 3.5, 1.5, 0.82, 1, 0.70, NULL, NULL FROM p
    UNION ALL SELECT k, 'functional_name', 'identity', 'functional', 3.5, 3.5, 0.88, fs, 0.35, CASE WHEN fs < 0.18 THEN 1 - fs END, NULL FROM p
    UNION ALL SELECT k, 'net_weight', 'quantity_packaging', 'net', 3.5, 3.5, 0.94, weight_sim, 0.88, CASE WHEN weight_sim < 0.45 THEN 1 - weight_sim END, NULL FROM p
    UNION ALL SELECT k, 'declared_count', 'quantity_packaging', 'count', 7, 7, 0.96, CASE WHEN counts_differ THEN 0 ELSE 1 END, 0.88, CASE WHEN counts_differ THEN 1 END, 'V008' FROM p
    UNION ALL SELECT k, 'flavor', 'form_variant', 'flavor', 7, 7, 0.94, CASE WHEN taste = 3 THEN 0 ELSE 1 END, 0.70, CASE WHEN taste = 3 THEN 1 END, 'V013' FROM p WHERE taste <= 3
    UNION ALL SELECT k, 'meat_species', 'food_composition', 'meat', 7, 7, 0.94, 1, 0.70, NULL, NULL FROM p WHERE food
),
good AS (
    SELECT k, cluster, attr, grp, capped AS w, q, sim AS s, capped * q * greatest(0.20, least(1, (sim - th) / (1 - th))) AS c FROM atoms WHERE sim >= th
    QUALIFY row_number() OVER (PARTITION BY k, cluster ORDER BY capped * q * greatest(0.20, least(1, (sim - th) / (1 - th))) DESC) = 1
),
bad AS (SELECT k, cluster, attr, grp, w, q, severity AS s, w * q * greatest(0.25, severity) AS c, CASE WHEN q >= 0.84 AND severity >= 0.55 THEN rule END AS rule FROM atoms WHERE severity IS NOT NULL AND q >= 0.72),
tied AS (
    SELECT 'g' AS side, x.k, sum(v) AS v FROM (SELECT x.k, 0.06::DOUBLE * sqrt(x.w * y.w) * least(x.s, y.s) * least(x.q, y.q) AS v FROM good x JOIN good y ON x.k = y.k AND x.attr < y.attr) x WHERE v >= 0.06 GROUP BY ALL
    UNION ALL SELECT 'b', x.k, sum(v) FROM (SELECT x.k, 0.07::DOUBLE * sqrt(x.w * y.w) * least(x.s, y.s) * least(x.q, y.q) AS v FROM bad x JOIN bad y ON x.k = y.k AND x.attr < y.attr) x WHERE v >= 0.07 GROUP BY ALL
),
g AS (SELECT k, sum(c) AS mass, count(DISTINCT grp) AS groups, count(*) AS n, count(*) FILTER (attr IN ('brand', 'functional_name', 'product_family')) AS anchors, count(*) FILTER (w >= 3.5) AS strong FROM good GROUP BY k),
b AS (SELECT k, sum(c) AS mass, count(DISTINCT grp) AS groups, count(*) AS n, coalesce(array_to_string(list_sort(list(DISTINCT rule) FILTER (rule IS NOT NULL)), ','), '') AS rules FROM bad GROUP BY k),
raw AS (
    SELECT p.*, g.n AS good_n, g.anchors, g.strong, coalesce(b.n, 0) AS bad_n, coalesce(b.rules, '') AS rules,
        (1 - exp(-(g.mass + least(coalesce(tg.v, 0), 0.25 * g.mass)) / 10)) * (0.45 + 0.20 * least(1, g.groups / 4) + 0.20 * least(1, g.anchors / 2) + 0.15 * least(1, g.strong / 3)) * (0.15 + 0.85 * greatest(0, least(1, (fs - 0.20) / 0.75))) AS m,
        coalesce((1 - exp(-(b.mass + least(coalesce(tb.v, 0), 0.25 * b.mass)) / 8)) * (0.70 + 0.30 * least(1, b.groups / 3)), 0) AS a
    FROM p JOIN g USING (k) LEFT JOIN b USING (k) LEFT JOIN tied tg ON tg.k = p.k AND tg.side = 'g' LEFT JOIN tied tb ON tb.k = p.k AND tb.side = 'b'
)
SELECT k AS row_key, round(least(m, CASE WHEN fs < 0.45 THEN 0.45 WHEN fs < 0.65 THEN 0.62 WHEN fs < 0.75 THEN 0.78 ELSE 1 END), 6)::DOUBLE AS match_evidence_score,
    round(CASE WHEN rules <> '' THEN greatest(a, 0.88) ELSE a END, 6)::DOUBLE AS nonmatch_evidence_score, round(fs, 6) AS functional_identity_similarity, good_n AS atomic_positive_evidence_count,
    anchors AS identity_anchor_count, strong AS strong_support_count, bad_n AS atomic_conflict_count, rules <> '' AS hard_veto, rules, CASE WHEN taste > 3 THEN 'flavor' ELSE '' END AS asymmetries,
    CASE WHEN private THEN 'PRIVATE' WHEN brands_differ THEN 'CONFLICT' ELSE 'SAME' END AS brand_policy, NOT brands_differ AS same_brand, k % 7 = 0 AS exact_title_match FROM raw
"""
QUERIES = {"evidence_scores": evidence_scores}
ORACLES = {"evidence_scores": _EVIDENCE}
