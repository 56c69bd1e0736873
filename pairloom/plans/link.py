"""The whole linkage: two catalogs in, one verdict for each row of the first."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import adjudicate, blocking, certify, collisions, facts, index, routing, scoring
from .stages import Run, cached, shared_folder, staged, unguessed


@dataclass(frozen=True)
class Settings:
    """What a caller may change: phrases, criteria and thresholds (see sources.config), a folder that keeps facts of b for later runs, and one for the
    stages of this run, from which a run that was stopped goes on (see stages.Run), the name under which b's tables are stored (see operators.index.build), and a folder that keeps the answers of one pair of clients
    (see operators.adjudicate.ask)."""

    lexicon: list | None = None
    criteria: list | None = None
    thresholds: routing.Thresholds = field(default_factory=routing.Thresholds)
    facts_path: str | None = None
    run_path: str | None = None
    index: str | None = None
    answers_path: str | None = None
    unicode: bool = True


Keep = Callable[[str, Callable[[], DataFrame]], DataFrame]


def _keep(name: str, make: Callable[[], DataFrame]) -> DataFrame:
    return staged(make())


def scored_pairs(a: DataFrame, b: DataFrame, s: Settings, keep: Keep = _keep) -> tuple[DataFrame, DataFrame]:
    """(all candidates, scored deep pairs): cheap retrieval first; facts of both sides only for what survives it."""
    named = keep("named", lambda: blocking.infer_brands(a, b))
    candidates = keep("candidates", lambda: blocking.retrieve(named, b, s.unicode, index.opened(a.sparkSession, s.index) if s.index else None))
    strong = candidates.where((F.col("retrieval_rank") == 1) & (F.col("retrieval_score") >= blocking.FLOOR)).select("row_key")
    deep = blocking.deep_shortlist(candidates.join(strong, "row_key", "left_semi"))
    names_a = named.select("row_key", F.col("item_id").alias("item_id_A"), F.col("name").alias("name_A"))
    names_b = b.select("b_index", F.col("name").alias("name_B"))
    pairs = keep("pairs", lambda: deep.join(names_a, "row_key").join(names_b, "b_index"))
    facts_a = keep("facts_a", lambda: facts.extract(named.join(pairs.select("row_key").distinct(), "row_key", "left_semi"), "row_key", s.lexicon, s.unicode))
    asked = b.join(pairs.select("b_index").distinct(), "b_index", "left_semi")
    of_b = lambda p: facts.extract(p, "b_index", s.lexicon, s.unicode)
    facts_b = keep("facts_b", lambda: cached(asked, "b_index", of_b, s.facts_path, repr((s.lexicon, s.unicode))) if s.facts_path else of_b(asked))
    return candidates, keep("scored", lambda: scoring.score_pairs(pairs, facts_a, facts_b, s.criteria))


def matched(verdicts: DataFrame, b: DataFrame) -> DataFrame:
    """Provisional matches with the target's metadata; of targets with one item id the last."""
    meta = b.groupBy(F.col("item_id").alias("target")).agg(F.max_by(F.struct("brand_raw", "description", "sizing_comp", "item_info"), "b_index").alias("m"))
    rows = verdicts.where("final_verdict = 'MATCH'").select("row_key", F.col("selected_item_id_B").alias("target"), "name_A", "name_B", "brand_policy")
    return rows.join(meta, "target").select("row_key", "target", "name_A", "name_B", "brand_policy", F.col("m.brand_raw").alias("brand_B"), F.substring("m.description", 1, 2000).alias("description_B"), F.substring("m.item_info", 1, 400).alias("info_B"), T.friendly_size(T.jsonish(F.col("m.sizing_comp"))).alias("size_B"))


def provisional(a: DataFrame, b: DataFrame, s: Settings, client: adjudicate.Client | None = None, keep: Keep = _keep, second: adjudicate.Client | None = None) -> DataFrame:
    """Verdicts of the rows of a, each by itself: no check yet compares the matches of one target.  Rows without a deep candidate are NON_MATCH."""
    with unguessed(a.sparkSession):
        _, pairs = scored_pairs(a, b, s, keep)
        pairs = routing.supported(pairs, s.thresholds)
        verdicts = routed = keep("routed", lambda: routing.settled(routing.route(pairs, s.thresholds)))
        if client is not None:
            shown = keep("shown", lambda: adjudicate.shown(pairs.join(verdicts.where("final_verdict = 'REVIEW'").select("row_key"), "row_key", "left_semi")))
            path = s.answers_path or shared_folder(a.sparkSession)
            verdicts = keep("adjudicated", lambda: adjudicate.accepted(routed, shown, adjudicate.adjudicated(adjudicate.packets(shown), client, path, second)))
    rest = a.join(verdicts.select("row_key").hint("merge"), "row_key", "left_anti").select("row_key", F.col("item_id").alias("item_id_A"), F.col("name").alias("name_A"))
    stub = rest.withColumn("final_verdict", F.lit("NON_MATCH")).withColumn("decision_reason", F.lit("WEAK_RETRIEVAL_NONMATCH"))
    return verdicts.unionByName(stub, allowMissingColumns=True)


def checked(verdicts: DataFrame, b: DataFrame, keep: Keep = _keep) -> DataFrame:
    """Provisional verdicts after recovery, the merge checks and the last check; the checks see all matches of a target together, recovered ones as well."""
    with unguessed(b.sparkSession):
        verdicts = keep("promoted", lambda: adjudicate.promoted(verdicts)) if "reviewer_decision" in verdicts.columns else adjudicate.promoted(verdicts)
        found = keep("matched", lambda: matched(verdicts, b))
        first = keep("collisions", lambda: collisions.demotions(found, staged))
        merged = keep("merged", lambda: certify.demoted(verdicts, first))
        last = keep("last_check", lambda: certify.certify(staged(matched(merged, b)), staged))
    return adjudicate.committed(certify.demoted(merged, last))


def link(a: DataFrame, b: DataFrame, lexicon: list | None = None, client: adjudicate.Client | None = None, unicode: bool = True, settings: Settings | None = None, second: adjudicate.Client | None = None) -> DataFrame:
    """One verdict for each row of a.

    a: row_key and the catalog columns; b: b_index and the catalog columns.  Rows without a deep candidate are NON_MATCH.
    settings go before lexicon and unicode.  client answers for rows under review, second for those that it leaves open.
    """
    s = settings or Settings(lexicon=lexicon, unicode=unicode)
    keep: Keep = Run(a.sparkSession, s.run_path, {"a": a, "b": b}, (s.lexicon, s.criteria, s.thresholds, s.unicode, client is not None, second is not None)).stage if s.run_path else _keep
    return checked(provisional(a, b, s, client, keep, second), b, keep)
