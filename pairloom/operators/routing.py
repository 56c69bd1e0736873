"""One verdict for each row: calibrated support, best and runner-up, decision lanes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as M
from . import guards


@dataclass(frozen=True)
class Thresholds:
    """Fixed values of the decision lanes; a caller may pass others."""

    match_coefficient: float = 6.564689133174299
    match_intercept: float = -5.141619688855791
    nonmatch_coefficient: float = 8.309152766631854
    nonmatch_intercept: float = -3.6557118086781757
    quantity: float = 0.72
    max_nonmatch: float = 0.35
    nonmatch_above: float = 0.70
    raw_below: float = 0.40
    support_below: float = 0.055
    functional_below: float = 0.38
    review_raw: tuple[float, float] = (0.46, 0.78)
    review_functional: float = 0.52
    review_support: float = 0.08
    #: raw, functional, support, margin
    same: tuple[float, float, float, float] = (0.52, 0.82, 0.10, 0.01)
    private: tuple[float, float, float, float] = (0.52, 0.88, 0.10, 0.015)
    general: tuple[float, float, float, float] = (0.68, 0.90, 0.20, 0.03)
    #: raw, functional, margin where the quantity is unknown
    same_unknown: tuple[float, float, float] = (0.60, 0.90, 0.03)
    private_unknown: tuple[float, float, float] = (0.58, 0.92, 0.03)
    #: raw, functional, margin
    best: tuple[float, float, float] = (0.62, 0.88, 0.03)


def supported(pairs: DataFrame, t: Thresholds) -> DataFrame:
    """pairs with match_confidence, nonmatch_confidence, pair_support_score and automatic_support_score."""
    import math

    floor = 1 / (1 + math.exp(-t.nonmatch_intercept))
    p = pairs.withColumn("match_confidence", M.calibrated(F.col("match_evidence_score"), t.match_coefficient, t.match_intercept))
    p = p.withColumn("nonmatch_confidence", M.calibrated(F.col("nonmatch_evidence_score"), t.nonmatch_coefficient, t.nonmatch_intercept))
    p = p.withColumn("pair_support_score", F.col("match_confidence") * (1 - M.clamp((F.col("nonmatch_confidence") - floor) / (1 - floor))))
    return p.withColumn("automatic_support_score", F.when(F.col("hard_veto"), 0.0).otherwise(F.col("pair_support_score")))


def best_and_margin(pairs: DataFrame) -> DataFrame:
    """The best pair of each row by support, then rank, then item id as text, with its runner-up, margin, candidate count and whether all are vetoed."""
    order = Window.partitionBy("row_key").orderBy(F.desc("automatic_support_score"), "retrieval_rank", F.col("item_id_B").cast("string"))
    whole = Window.partitionBy("row_key")
    p = pairs.withColumn("__n", F.row_number().over(order)).withColumn("runner_up_item_id_B", F.coalesce(F.lead("item_id_B").over(order), F.lit("")))
    p = p.withColumn("runner_up_support_score", F.coalesce(F.lead("automatic_support_score").over(order), F.lit(0.0)))
    p = p.withColumn("candidate_count", F.count("*").over(whole)).withColumn("all_veto", F.min("hard_veto").over(whole))
    return p.where("__n = 1").drop("__n").withColumn("runner_up_margin", F.col("automatic_support_score") - F.col("runner_up_support_score"))


def route(pairs: DataFrame, t: Thresholds | None = None) -> DataFrame:
    """Verdict and reason of each row's best pair; pairs as scored, one row or more for each row_key."""
    t = t or Thresholds()
    c = F.col
    p = best_and_margin(supported(pairs, t))
    raw, fs, ps, nm, margin = (c(x) for x in ("match_evidence_score", "functional_identity_similarity", "pair_support_score", "nonmatch_confidence", "runner_up_margin"))
    evidence, anchors, rank = c("atomic_positive_evidence_count"), c("identity_anchor_count"), c("retrieval_rank")
    policy, clean = c("brand_policy"), c("modifier_asymmetry_count") == 0
    known = c("quantity_similarity") >= 0
    fine = ~known | (c("quantity_similarity") >= t.quantity)
    brand_ok = c("same_brand") | c("private_label_pair") | policy.isin("SAME", "SAME_INFERRED", "PRIVATE", "COMMODITY")
    reaches = lambda v: (raw >= v[0]) & (fs >= v[1]) & (ps >= v[2]) & (margin >= v[3])
    over = lambda v: (raw >= v[0]) & (fs >= v[1]) & (margin >= v[2])
    plain = (rank == 1) & fine & clean & (anchors >= 2)
    same = (c("same_brand") | policy.isin("SAME", "SAME_INFERRED")) & plain & reaches(t.same) & (evidence >= 3) & (known | (over(t.same_unknown) & (evidence >= 4)))
    private = c("private_label_pair") & plain & reaches(t.private) & (evidence >= 3) & (known | over(t.private_unknown))
    general = (policy == "COMMODITY") & plain & reaches(t.general) & (evidence >= 4)
    exact = c("exact_title_match") & brand_ok & clean & fine
    lane = ~c("hard_veto") & (policy != "CONFLICT") & (nm <= t.max_nonmatch) & (exact | same | private | general)
    weak = (raw < t.raw_below) | (ps < t.support_below) | (fs < t.functional_below)
    against = c("hard_veto") | (policy == "CONFLICT") | (nm >= t.nonmatch_above)
    band = raw.between(*t.review_raw) & (fs >= t.review_functional) & (ps >= t.review_support) & ((rank <= 3) | (margin >= 0.04))
    strong = brand_ok & (rank == 1) & over(t.best) & known & fine & (nm < t.max_nonmatch) & clean
    reason = F.when(lane, "AGGRESSIVE_MATCH_LANE").when(c("all_veto") | against | weak, "CLEAR_NONMATCH").when(band, "NARROW_DECISION_BAND").when(strong, "BEST_EVIDENCE_MATCH").otherwise("BEST_EVIDENCE_NONMATCH")
    p = p.withColumn("decision_reason", reason)
    verdict = F.when(c("decision_reason").isin("AGGRESSIVE_MATCH_LANE", "BEST_EVIDENCE_MATCH"), "MATCH").when(c("decision_reason") == "NARROW_DECISION_BAND", "REVIEW").otherwise("NON_MATCH")
    guess = F.when(~c("hard_veto") & (ps >= 0.10) & (fs >= 0.50), "MATCH").otherwise("NON_MATCH")
    return p.withColumn("final_verdict", verdict).withColumn("educated_guess", guess)


def settled(routed: DataFrame) -> DataFrame:
    """The routed rows after rescue review, promotion and the firewall, in that order."""
    c = F.col
    rescue = (c("final_verdict") == "MATCH") & (c("retrieval_rescue_type") != "")
    p = routed.withColumn("decision_reason", F.when(rescue, "RECALL_RESCUE_REVIEW").otherwise(c("decision_reason"))).withColumn("final_verdict", F.when(rescue, "REVIEW").otherwise(c("final_verdict")))
    p = guards.prepared(p)
    p = p.withColumn("__why", F.when(c("final_verdict") == "REVIEW", guards.promotion()))
    p = p.withColumn("decision_reason", F.coalesce("__why", "decision_reason")).withColumn("final_verdict", F.when(c("__why").isNotNull(), "MATCH").otherwise(c("final_verdict"))).drop("__why")
    p = p.withColumn("final_safety_blocker", F.when(c("final_verdict") == "MATCH", guards.firewall()).otherwise(""))
    blocked = c("final_safety_blocker") != ""
    action = F.when(c("final_safety_blocker").isin(*guards.HARD), "NON_MATCH").otherwise("REVIEW")
    p = p.withColumn("final_verdict", F.when(blocked, action).otherwise(c("final_verdict")))
    p = p.withColumn("decision_reason", F.when(blocked, F.concat(F.lit("FINAL_SAFETY_"), c("final_verdict"))).otherwise(c("decision_reason")))
    matched = c("final_verdict") == "MATCH"
    return guards.unprepared(p).withColumn("selected_item_id_B", F.when(matched, c("item_id_B")).otherwise("")).withColumn("manual_review_required", c("final_verdict") == "REVIEW")


def with_context(routed: DataFrame) -> DataFrame:
    """Rows that a second look may change: those under review, and plausible others without a veto, near the top and hardly contradicted."""
    c = F.col
    plausible = ~c("hard_veto") & c("brand_policy").isin("SAME", "SAME_INFERRED", "PRIVATE", "COMMODITY") & (c("nonmatch_confidence") < 0.35) & (c("pair_support_score") >= 0.055) & (c("retrieval_rank") <= 3)
    return routed.where((c("final_verdict") == "REVIEW") | plausible)
