"""Optional adjudication of rows under review by an outside model, behind an interface.

A client gets groups of packets and answers each.  What it said is kept in a folder, request by request, so no task that is started anew and no later run asks for a packet again; a run that ends packs its requests into one table.
A second pass, in smaller groups, asks for what the first left open.  Answers never override an explicit contradiction: the pair they pick passes the firewall first.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.stages import deleted, exists
from . import guards

#: Packets of a request and requests at once, in the first pass and in the second; candidates that a packet shows.
GROUP, CONCURRENCY = 24, 12
SECOND_GROUP, SECOND_CONCURRENCY = 12, 8
SHOWN = 2
ANSWER = "row_key long, choice int, decision string, match_type string, blocker string, evidence string"
_FIELDS = [x.split()[0] for x in ANSWER.split(", ")]
#: Decisions that close a case, and those that leave it open.
CLOSED, OPEN = ("MATCH", "NON_MATCH"), ("REVIEW", "UNCERTAIN")
Client = Callable[[list[dict]], list[dict]]


def silent(packets: list[dict]) -> list[dict]:
    return []


def shown(pairs: DataFrame) -> DataFrame:
    """The best unvetoed candidates of each row, numbered by n from 1: what a packet shows."""
    order = Window.partitionBy("row_key").orderBy(F.desc("pair_support_score"), "retrieval_rank", F.col("item_id_B").cast("string"))
    return pairs.where(~F.col("hard_veto")).withColumn("n", F.row_number().over(order)).where(F.col("n") <= SHOWN)


def packets(candidates: DataFrame) -> DataFrame:
    """(row_key, payload): the shown() candidates of each row as JSON."""
    one = F.struct("n", "item_id_B", "name_B", F.round("pair_support_score", 4).alias("support"), "brand_policy")
    body = candidates.groupBy("row_key").agg(F.min("name_A").alias("name"), F.array_sort(F.collect_list(one)).alias("candidates"))
    return body.select("row_key", F.to_json(F.struct("row_key", "name", "candidates")).alias("payload"))


class Requests:
    """Requests of one pass, each kept as a file under path that is named by its packets and moved there whole."""

    def __init__(self, client: Client, path: str) -> None:
        from pyarrow import fs

        self.client = client
        self.files, self.path = fs.FileSystem.from_uri(path)
        self.files.create_dir(self.path, recursive=True)

    def settle(self, group: list[tuple[str, dict]]) -> str:
        """Makes sure that the answers of the group's packets (id, content) are kept; their lines.

        A group whose request fails with RuntimeError is kept as an empty file and halved; a single packet that fails has no answer.
        """
        name = hashlib.sha256(" ".join(k for k, _ in group).encode()).hexdigest()
        file = f"{self.path}/{name}.json"
        if self.files.get_file_info(file).is_file:
            with self.files.open_input_stream(file) as kept:
                lines = kept.read().decode()
        else:
            try:
                lines = self._lines(group, self.client([p for _, p in group]))
            except RuntimeError:
                lines = "" if len(group) > 1 else self._lines(group, [])
            self._keep(name, lines)
        if lines:
            return lines
        half = len(group) // 2
        return self.settle(group[:half]) + self.settle(group[half:])

    def _lines(self, group: list[tuple[str, dict]], answers: list[dict]) -> str:
        """A line for each packet, with the first valid answer for its row."""
        by_row = {a.get("row_key"): a for a in reversed(answers) if a.get("decision") in CLOSED + OPEN}
        return "".join(json.dumps({"packet": k, **{x: by_row.get(p["row_key"], {}).get(x) for x in _FIELDS[1:]}, "row_key": p["row_key"]}) + "\n" for k, p in group)

    def _keep(self, name: str, lines: str) -> None:
        made = f"{self.path}/.{name}-{uuid.uuid4().hex}"
        with self.files.open_output_stream(made) as out:
            out.write(lines.encode())
        if self.files.get_file_info(f"{self.path}/{name}.json").is_file:
            self.files.delete_file(made)
        else:
            self.files.move(made, f"{self.path}/{name}.json")


def ask(rows: DataFrame, client: Client, path: str, group: int = GROUP, concurrency: int = CONCURRENCY) -> DataFrame:
    """Answers (row_key, choice, decision, match_type, blocker, evidence) to the packets in rows (row_key, payload), asking only for those that path doesn't hold.

    path is a folder of one client and pass that all executors share and one run writes at a time.  A packet is known by its payload, so a row whose candidates change is asked again, and
    repeated rows are asked once.  Groups follow from the packets alone and each request is kept before the next is made: a task that is started anew goes on
    after its last kept request, and only a request that was under way is made twice (two attempts at once, as in speculation, may ask twice).
    Files of single requests serve the run that made them, or the next one if it was cut off: at its end all answers are in the table packed, so that no query lists and opens a file for each request.
    Rows without an answer are left out; that they have none is kept as well.
    """
    spark = rows.sparkSession
    rows = rows.select("row_key", "payload", F.sha2("payload", 256).alias("packet"))
    single, packed, schema = f"{path}/requests", f"{path}/packed", f"packet string, {ANSWER}"
    none = spark.createDataFrame([], schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        requests, held, lines = Requests(client, single), [], []

        def answers() -> pd.DataFrame:
            got = pd.DataFrame([json.loads(x) for x in lines], columns=["packet", *_FIELDS])
            lines.clear()
            return got.astype({"row_key": "Int64", "choice": "Int32"})

        for b in batches:
            held += zip(b["packet"], map(json.loads, b["payload"]), strict=True)
            while len(held) >= group:
                lines += requests.settle(held[:group]).splitlines()
                held = held[group:]
            yield answers()
        if held:
            lines += requests.settle(held).splitlines()
            yield answers()

    before = spark.read.schema(schema).parquet(packed) if exists(spark, f"{packed}/_SUCCESS") else none
    left = spark.read.schema(schema).json(single) if exists(spark, single) else none
    todo = rows.select("packet", "payload").where("payload is not null").join(before.unionByName(left).select("packet"), "packet", "left_anti").dropDuplicates(["packet"])
    made = todo.repartition(concurrency, "packet").sortWithinPartitions("packet").mapInPandas(run, schema)
    made.unionByName(left).write.mode("append").parquet(packed)
    deleted(spark, single)
    found = spark.read.schema(schema).parquet(packed).where("decision is not null").groupBy("packet").agg(F.min(F.struct(*_FIELDS[1:])).alias("a")).select("packet", "a.*")
    return rows.select("row_key", "packet").distinct().join(found, "packet").select(*_FIELDS)


def adjudicated(rows: DataFrame, client: Client, path: str, second: Client | None = None, most: int | None = None) -> DataFrame:
    """Answers of two passes: what the first left open (no answer, an open decision, insufficient evidence) goes to the second, whose answers then count.

    most bounds the packets of the second pass (those with the smallest row_key); none by default.
    """
    first = ask(rows, client, f"{path}/first")
    if second is None:
        return first
    sure = first.where(F.col("decision").isin(*CLOSED) & (F.coalesce("evidence", F.lit("")) != "INSUFFICIENT"))
    unsure = rows.join(sure.select("row_key"), "row_key", "left_anti")
    if most is not None:
        unsure = unsure.orderBy("row_key").limit(most)
    again = ask(unsure, second, f"{path}/second", SECOND_GROUP, SECOND_CONCURRENCY)
    return again.unionByName(first.join(again.select("row_key"), "row_key", "left_anti"))


def _fits(policy: Column, kind: Column) -> Column:
    """Whether the kind of match that an answer names is one that the brands allow."""
    return F.coalesce(
        F.when(policy.isin("SAME", "SAME_INFERRED"), kind == "SAME_BRAND_PRODUCT")
        .when(policy == "PRIVATE", kind.isin("PRIVATE_LABEL_EQUIVALENT", "SAME_BRAND_PRODUCT"))
        .when(policy == "COMMODITY", kind == "COMMODITY_EQUIVALENT"),
        F.lit(False),
    )


def _enough(policy: Column, clear: Column, rank: Column, support: Column, functional: Column) -> Column:
    """Whether a pair is strong enough for a match in spite of an omission; the fewer brands say, the more is asked."""
    strict = policy.isin("SAME_INFERRED", "COMMODITY")
    least = (support >= 0.055) & (functional >= 0.48)
    return F.when(strict, clear & (rank == 1) & least).when(clear, (rank <= 2) & least).otherwise((rank <= 2) & (support >= 0.075) & (functional >= 0.58))


def accepted(routed: DataFrame, candidates: DataFrame, answers: DataFrame) -> DataFrame:
    """routed with the answers (reviewer_choice and so on) of rows under review, and their consequences.

    A row whose answer picks a candidate (of shown()) takes that pair's columns and becomes a match, if the firewall finds nothing and the evidence is clear, or probable
    near the top; or if the firewall finds an omission only and the pair is strong.  A pair that the firewall refuses makes it a NON_MATCH.  Other answers change no verdict.
    """
    c = F.col
    a = answers.select("row_key", *[c(x).alias(f"reviewer_{x}") for x in _FIELDS[1:]])
    picked = a.where("reviewer_decision = 'MATCH'").select("row_key", c("reviewer_choice").alias("n"))
    pairs = guards.unprepared(guards.prepared(candidates.join(picked, ["row_key", "n"])).withColumn("__block", guards.firewall())).drop("n")
    taken = [x for x in pairs.columns if x in routed.columns and x != "row_key"]
    r = routed.join(a, "row_key", "left").join(pairs.select("row_key", F.struct("__block", *taken).alias("__pair")), "row_key", "left")
    pair = lambda x: c("__pair")[x]
    policy, rank, support, clear = pair("brand_policy"), pair("retrieval_rank"), pair("pair_support_score"), c("reviewer_evidence") == "CLEAR"
    asked = (c("final_verdict") == "REVIEW") & c("__pair").isNotNull()
    refused = asked & pair("__block").isin(*guards.HARD)
    certain = (c("reviewer_blocker") == "NONE") & c("reviewer_evidence").isin("CLEAR", "PROBABLE") & _fits(policy, c("reviewer_match_type"))
    certain = certain & (~policy.isin("SAME_INFERRED", "COMMODITY") | (clear & (rank == 1)))
    enough = F.when(pair("__block") == "", clear | ((rank <= 2) & (support >= 0.055))).otherwise(_enough(policy, clear, rank, support, pair("functional_identity_similarity")))
    r = r.withColumn("__no", F.coalesce(refused, F.lit(False))).withColumn("__yes", F.coalesce(asked & ~refused & certain & enough, F.lit(False)))
    yes, no = c("__yes"), c("__no")
    r = r.withColumns({x: F.when(yes, pair(x)).otherwise(c(x)) for x in taken})
    r = r.withColumn("selected_item_id_B", F.when(yes, c("item_id_B")).otherwise(c("selected_item_id_B"))).withColumn("reviewed", c("reviewer_decision").isNotNull())
    r = r.withColumn("semantic_soft_resolved", F.when(yes, pair("__block")).otherwise(""))
    r = r.withColumn("final_safety_blocker", F.when(yes, "").when(asked, pair("__block")).otherwise(c("final_safety_blocker")))
    r = r.withColumn("decision_reason", F.when(yes, "ADJUDICATED_MATCH").when(no, "FINAL_SAFETY_NON_MATCH").otherwise(c("decision_reason")))
    r = r.withColumn("manual_review_required", c("manual_review_required") & ~yes & ~no)
    return r.withColumn("final_verdict", F.when(yes, "MATCH").when(no, "NON_MATCH").otherwise(c("final_verdict"))).drop("__pair", "__yes", "__no")


def promoted(verdicts: DataFrame) -> DataFrame:
    """verdicts with rows recovered: those under review whose answer says that their best candidate matches, held back by an omission only, become matches.

    They are provisional: the merge checks and the last check then see them together with the standing matches, and send back what doesn't hold.
    The column recovered marks them; verdicts that were never reviewed have none.
    """
    c = F.col
    if "reviewer_decision" not in verdicts.columns:
        return verdicts.withColumn("recovered", F.lit(False))
    clear = c("reviewer_evidence") == "CLEAR"
    says = (c("reviewer_decision") == "MATCH") & (c("reviewer_choice") == 1) & (c("reviewer_blocker") == "NONE") & c("reviewer_evidence").isin("CLEAR", "PROBABLE")
    strong = _enough(c("brand_policy"), clear, c("retrieval_rank"), c("pair_support_score"), c("functional_identity_similarity"))
    yes = (c("final_verdict") == "REVIEW") & says & _fits(c("brand_policy"), c("reviewer_match_type")) & strong & ~F.coalesce(c("final_safety_blocker"), F.lit("")).isin(*guards.HARD)
    v = verdicts.withColumn("recovered", F.coalesce(yes, F.lit(False)))
    yes = c("recovered")
    v = v.withColumn("selected_item_id_B", F.when(yes, c("item_id_B")).otherwise(c("selected_item_id_B"))).withColumn("decision_reason", F.when(yes, "METADATA_RECOVERY_MATCH").otherwise(c("decision_reason")))
    if "semantic_soft_resolved" in v.columns:
        v = v.withColumn("semantic_soft_resolved", F.when(yes, c("final_safety_blocker")).otherwise(c("semantic_soft_resolved")))
    v = v.withColumn("final_safety_blocker", F.when(yes, "").otherwise(c("final_safety_blocker"))).withColumn("manual_review_required", c("manual_review_required") & ~yes)
    return v.withColumn("final_verdict", F.when(yes, "MATCH").otherwise(c("final_verdict")))


def committed(verdicts: DataFrame) -> DataFrame:
    """promoted() verdicts after the checks: recovered stays true for rows that the checks left as matches."""
    return verdicts.withColumn("recovered", F.col("recovered") & (F.col("final_verdict") == "MATCH"))
