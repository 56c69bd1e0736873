"""Queries over the firewall, adjudication in two passes and recovery, each with its SQL.

The outside client is a stand-in whose answers follow from a packet's key and candidates, so that SQL can say them as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import adjudicate, routing
from ..sources.catalog import parts
from . import verdict_queries as V
from .stages import shared_folder, staged

_KINDS = {"SAME": "SAME_BRAND_PRODUCT", "SAME_INFERRED": "SAME_BRAND_PRODUCT", "PRIVATE": "PRIVATE_LABEL_EQUIVALENT", "COMMODITY": "COMMODITY_EQUIVALENT"}


def _answer(packet: dict, decision: str, evidence: str) -> dict:
    key, found = packet["row_key"], packet["candidates"]
    choice = 2 if key % 3 == 0 and len(found) > 1 else 1
    kind = _KINDS.get(found[choice - 1]["brand_policy"], "NONE")
    return {"row_key": key, "choice": choice, "decision": decision, "match_type": kind, "blocker": "OTHER" if key % 11 == 0 else "NONE", "evidence": evidence}


def quick(packets: list[dict]) -> list[dict]:
    """Refuses requests with a key divisible by 50; is uncertain of every seventh key."""
    if any(p["row_key"] % 50 == 0 for p in packets):
        raise RuntimeError("refused")
    return [_answer(p, {0: "UNCERTAIN", 1: "NON_MATCH"}.get(p["row_key"] % 7, "MATCH"), {0: "PROBABLE", 1: "INSUFFICIENT"}.get(p["row_key"] % 5, "CLEAR")) for p in packets]


def thorough(packets: list[dict]) -> list[dict]:
    return [_answer(p, "MATCH" if p["row_key"] % 2 == 0 else "UNCERTAIN", "CLEAR") for p in packets]


def _reviewed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(routed rows, candidates shown of those under review, answers of both passes)."""
    soap = F.lit("Plain soap")
    asym = F.when(F.col("item_id_B").cast("long") % 5 == 0, F.array(F.lit("flavor"))).otherwise(F.array().cast("array<string>"))
    pairs = routing.supported(V.scored(spark, sf_dir), routing.Thresholds()).withColumns({"name_A": soap, "name_B": soap, "modifier_asymmetries": asym})
    r = routing.route(pairs).withColumns({"selected_item_id_B": F.when(F.col("final_verdict") == "MATCH", F.col("item_id_B")).otherwise(""), "final_safety_blocker": F.lit(""), "manual_review_required": F.col("final_verdict") == "REVIEW"})
    r = staged(r)
    shown = staged(adjudicate.shown(pairs.join(r.where("final_verdict = 'REVIEW'").select("row_key"), "row_key", "left_semi")))
    return r, shown, adjudicate.adjudicated(adjudicate.packets(shown), quick, shared_folder(spark), thorough)


def adjudication_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of two passes for the rows under review."""
    return _reviewed(spark, sf_dir)[2]


def adjudicated_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of all rows after the answers."""
    v = adjudicate.accepted(*_reviewed(spark, sf_dir))
    return v.select("row_key", "item_id_B", "final_verdict", "selected_item_id_B", "decision_reason", "final_safety_blocker", "semantic_soft_resolved", "manual_review_required", "reviewed")


#: Two parts to a target, as in merge_reasons; even ones are standing matches, odd ones wait for recovery, and every third is too weak for it.
_WAITING = f"""
SELECT row_key, target AS item_id_B, name_A, name_B, brand_policy, size_B, CAST(row_key AS STRING) AS item_id_A,
    CASE WHEN row_key % 2 = 0 THEN 'MATCH' ELSE 'REVIEW' END AS final_verdict, CASE WHEN row_key % 2 = 0 THEN target ELSE '' END AS selected_item_id_B, CASE WHEN row_key % 2 = 0 THEN '' ELSE 'ONE_SIDED_EXPLICIT_COUNT' END AS final_safety_blocker,
    row_key % 2 = 1 AS manual_review_required, CASE WHEN row_key % 2 = 0 THEN 'AGGRESSIVE_MATCH_LANE' ELSE 'NARROW_DECISION_BAND' END AS decision_reason, 1 AS retrieval_rank,
    CASE WHEN row_key % 3 = 0 THEN CAST(0.05 AS DOUBLE) ELSE CAST(0.06 AS DOUBLE) END AS pair_support_score, CAST(0.5 AS DOUBLE) AS functional_identity_similarity,
    CASE WHEN row_key % 2 = 1 THEN 'MATCH' END AS reviewer_decision, 1 AS reviewer_choice, CASE brand_policy WHEN 'COMMODITY' THEN 'COMMODITY_EQUIVALENT' ELSE 'PRIVATE_LABEL_EQUIVALENT' END AS reviewer_match_type,
    'NONE' AS reviewer_blocker, 'CLEAR' AS reviewer_evidence
FROM ({V._MERGES})"""


def recovered_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that recovery promotes, checked together with the standing matches of their targets."""
    from .link import checked

    rows = staged(spark.sql(_WAITING, part=parts(spark, sf_dir)))
    sizing = F.to_json(F.struct(F.col("size_B").alias("size_user_friendly")))
    b = rows.groupBy("item_id_B").agg(F.max("size_B").alias("size_B")).select(F.col("item_id_B").cast("long").alias("b_index"), F.col("item_id_B").alias("item_id"), F.lit("acme").alias("brand_raw"), F.lit("").alias("description"), F.lit("").alias("item_info"), sizing.alias("sizing_comp"))
    return checked(rows.drop("size_B"), b).select("row_key", "final_verdict", "selected_item_id_B", "final_safety_blocker", "decision_reason", "recovered")


#: Pairs of twelve forms: one for each rule of the firewall, and one that all let pass.
_PAIRS = """
SELECT p_partkey AS row_key, form, CAST(p_partkey AS {text}) AS item_id_B, 'MATCH' AS final_verdict, 'AGGRESSIVE_MATCH_LANE' AS decision_reason, '' AS retrieval_rescue_type, 1 AS retrieval_rank, form = 0 AS hard_veto,
    CASE form WHEN 1 THEN 'CONFLICT' ELSE 'SAME' END AS brand_policy, CASE form WHEN 8 THEN CAST(0.45 AS DOUBLE) ELSE CAST(-1 AS DOUBLE) END AS quantity_similarity,
    CASE form WHEN 2 THEN 'Native deodorant' WHEN 3 THEN 'Brew ground coffee' WHEN 4 THEN 'Lemon tea' WHEN 5 THEN concat('Soap ', n, ' count') WHEN 6 THEN 'Organic oats' WHEN 7 THEN concat('Soap ', n, ' count')
        WHEN 9 THEN 'Deep conditioner' WHEN 10 THEN 'Lemon lime tea' ELSE 'Plain soap' END AS name_A,
    CASE form WHEN 2 THEN 'Native body wash' WHEN 3 THEN 'Brew coffee capsules' WHEN 4 THEN 'Cherry tea' WHEN 5 THEN concat('Soap ', m, ' count') WHEN 6 THEN 'Non organic oats' WHEN 7 THEN 'Soap'
        WHEN 9 THEN 'Conditioner' WHEN 10 THEN 'Lemon tea' ELSE 'Plain soap' END AS name_B
FROM (SELECT p_partkey, p_partkey % 13 AS form, CAST(p_size + 2 AS {text}) AS n, CAST(p_size + 3 AS {text}) AS m FROM {part})"""


def firewall_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches that the firewall stops, with the rule that did."""
    rows = spark.sql(_PAIRS.format(text="STRING", part="{part}"), part=parts(spark, sf_dir))
    asym = F.when(F.col("form") == 11, F.array(F.lit("scent"), F.lit("color"), F.lit("unheard of"))).otherwise(F.array().cast("array<string>"))
    zero = {x: F.lit(0.0) for x in ("match_evidence_score", "functional_identity_similarity", "pair_support_score", "runner_up_margin", "nonmatch_confidence")}
    found = routing.settled(rows.withColumns({"modifier_asymmetries": asym, **zero, "atomic_positive_evidence_count": F.lit(0), "identity_anchor_count": F.lit(0)}))
    return found.select("row_key", "final_verdict", "final_safety_blocker", "decision_reason", "selected_item_id_B", "manual_review_required")


_SHOWN = """, shown AS (
    SELECT s.*, row_number() OVER (PARTITION BY row_key ORDER BY pair_support_score DESC, retrieval_rank, s."item_id_B") AS n FROM supported s
    WHERE NOT hard_veto AND row_key IN (SELECT row_key FROM routed WHERE final_verdict = 'REVIEW')
),
packets AS (SELECT row_key, least(count(*), 2) AS n_shown, CAST(CASE WHEN row_key % 3 = 0 AND count(*) > 1 THEN 2 ELSE 1 END AS INTEGER) AS choice FROM shown GROUP BY 1),
first AS (
    SELECT *, CASE row_key % 7 WHEN 0 THEN 'UNCERTAIN' WHEN 1 THEN 'NON_MATCH' ELSE 'MATCH' END AS decision, CASE row_key % 5 WHEN 0 THEN 'PROBABLE' WHEN 1 THEN 'INSUFFICIENT' ELSE 'CLEAR' END AS evidence, row_key % 50 <> 0 AS heard FROM packets
),
passes AS (
    SELECT row_key, choice, heard AND decision <> 'UNCERTAIN' AND evidence <> 'INSUFFICIENT' AS sure, decision, evidence FROM first
),
answers AS (
    SELECT b.row_key, b.choice, CASE WHEN sure THEN decision WHEN b.row_key % 2 = 0 THEN 'MATCH' ELSE 'UNCERTAIN' END AS decision,
        CASE WHEN s.brand_policy IN ('SAME', 'SAME_INFERRED') THEN 'SAME_BRAND_PRODUCT' WHEN s.brand_policy = 'PRIVATE' THEN 'PRIVATE_LABEL_EQUIVALENT' WHEN s.brand_policy = 'COMMODITY' THEN 'COMMODITY_EQUIVALENT' ELSE 'NONE' END AS match_type,
        CASE WHEN b.row_key % 11 = 0 THEN 'OTHER' ELSE 'NONE' END AS blocker, CASE WHEN sure THEN evidence ELSE 'CLEAR' END AS evidence
    FROM passes b JOIN shown s ON s.row_key = b.row_key AND s.n = b.choice
)
"""
_JUDGED = (
    V._ROUTED
    + _SHOWN
    + """, picked AS (
    SELECT s.*, a.blocker, a.evidence, a.match_type, CASE WHEN s.brand_policy NOT IN ('SAME', 'SAME_INFERRED', 'PRIVATE', 'COMMODITY') THEN 'BRAND' WHEN s.quantity_similarity > 0 AND s.quantity_similarity < 0.72 THEN 'QUANTITY'
        WHEN CAST(s."item_id_B" AS BIGINT) % 5 = 0 THEN 'ATTRIBUTE_ASYMMETRY:flavor' ELSE '' END AS block
    FROM answers a JOIN shown s ON s.row_key = a.row_key AND s.n = a.choice WHERE a.decision = 'MATCH'
),
settled AS (
    SELECT *, block IN ('BRAND', 'QUANTITY') AS refused, block NOT IN ('BRAND', 'QUANTITY') AND blocker = 'NONE' AND evidence IN ('CLEAR', 'PROBABLE') AND match_type <> 'NONE' AND (brand_policy IN ('SAME', 'PRIVATE') OR (evidence = 'CLEAR' AND retrieval_rank = 1))
        AND CASE WHEN block = '' THEN evidence = 'CLEAR' OR (retrieval_rank <= 2 AND pair_support_score >= 0.055)
            WHEN evidence = 'CLEAR' THEN retrieval_rank <= 2 AND pair_support_score >= 0.055 AND functional_identity_similarity >= 0.48
            ELSE retrieval_rank <= 2 AND pair_support_score >= 0.075 AND functional_identity_similarity >= 0.58 END AS ok FROM picked
)
SELECT r.row_key, CASE WHEN coalesce(s.ok, false) THEN s."item_id_B" ELSE r."item_id_B" END AS "item_id_B", CASE WHEN s.ok THEN 'MATCH' WHEN s.refused THEN 'NON_MATCH' ELSE r.final_verdict END AS final_verdict,
    CASE WHEN s.ok THEN s."item_id_B" WHEN r.final_verdict = 'MATCH' THEN r."item_id_B" ELSE '' END AS "selected_item_id_B",
    CASE WHEN s.ok THEN 'ADJUDICATED_MATCH' WHEN s.refused THEN 'FINAL_SAFETY_NON_MATCH' ELSE r.decision_reason END AS decision_reason,
    CASE WHEN s.ok OR s.row_key IS NULL THEN '' ELSE s.block END AS final_safety_blocker, CASE WHEN s.ok THEN s.block ELSE '' END AS semantic_soft_resolved,
    r.final_verdict = 'REVIEW' AND NOT coalesce(s.ok, false) AND NOT coalesce(s.refused, false) AS manual_review_required, a.row_key IS NOT NULL AS reviewed
FROM routed r LEFT JOIN settled s ON s.row_key = r.row_key LEFT JOIN answers a ON a.row_key = r.row_key"""
)
QUERIES = {f.__name__: f for f in (adjudication_answers, adjudicated_verdicts, recovered_matches, firewall_verdicts)}
ORACLES = {
    "adjudication_answers": V._ROUTED + _SHOWN + "SELECT * FROM answers",
    "adjudicated_verdicts": _JUDGED,
    "recovered_matches": """WITH f AS (SELECT p_partkey AS row_key, p_partkey // 2 AS target, p_partkey // 2 % 5 AS kind, p_partkey % 2 = 1 AS odd, p_partkey % 2 = 1 AND p_partkey % 3 <> 0 AS up FROM part),
    g AS (SELECT *, bool_or(up) OVER (PARTITION BY target) AS pair FROM f WHERE kind <> 0 OR NOT odd),
    w AS (
        SELECT *, CASE WHEN odd AND NOT up THEN NULL WHEN kind = 1 AND pair AND NOT odd THEN 'V17_COLLISION_GENERAL_COUNT' WHEN kind = 2 THEN 'B_METADATA_SIZE' WHEN kind = 3 THEN 'B_METADATA_ROLE' WHEN kind = 4 AND pair AND NOT odd THEN 'B_COLLISION_BEST_STRUCTURED_SIZE' END AS why FROM g
    )
    SELECT row_key, CASE WHEN why IS NOT NULL OR (odd AND NOT up) THEN 'REVIEW' ELSE 'MATCH' END AS final_verdict, CASE WHEN why IS NOT NULL OR (odd AND NOT up) THEN '' ELSE CAST(target AS VARCHAR) END AS "selected_item_id_B",
        CASE WHEN why IS NOT NULL THEN why WHEN odd AND NOT up THEN 'ONE_SIDED_EXPLICIT_COUNT' ELSE '' END AS final_safety_blocker,
        CASE WHEN up THEN 'METADATA_RECOVERY_MATCH' WHEN odd THEN 'NARROW_DECISION_BAND' ELSE 'AGGRESSIVE_MATCH_LANE' END AS decision_reason, up AND why IS NULL AS recovered FROM w""",
    "firewall_verdicts": f"""WITH t AS ({_PAIRS.format(text="VARCHAR", part="part")}),
    c AS (SELECT *, ['HARD_VETO', 'BRAND', 'ROLE', 'FORM', 'FLAVOR_SCENT_SHADE', 'QUANTITY', 'ORGANIC_STATUS', 'ONE_SIDED_EXPLICIT_COUNT', 'QUANTITY', 'ONE_SIDED_PRODUCT_SUBTYPE', 'PARTIAL_FLAVOR_SCENT_VARIANT', 'ATTRIBUTE_ASYMMETRY:color,scent', ''][form + 1] AS code FROM t),
    v AS (SELECT *, CASE WHEN code = '' THEN 'MATCH' WHEN form IN (7, 9, 10, 11) THEN 'REVIEW' ELSE 'NON_MATCH' END AS verdict FROM c)
    SELECT row_key, verdict AS final_verdict, code AS final_safety_blocker, CASE WHEN code = '' THEN decision_reason ELSE 'FINAL_SAFETY_' || verdict END AS decision_reason,
        CASE WHEN code = '' THEN "item_id_B" ELSE '' END AS "selected_item_id_B", verdict = 'REVIEW' AS manual_review_required FROM v""",
}
