"""Summaries, comparisons and queues over verdicts and catalogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as M


def histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c.cast("string")) == "")


def profile(df: DataFrame, id_col: str) -> DataFrame:
    """One row for each column: rows, blank share, distinct ids and duplicate ids, from a single aggregation."""
    stats = df.agg(F.count("*").alias("rows"), F.countDistinct(id_col).alias("unique_ids"), *[F.count_if(blank(F.col(c))).alias(f"__{i}") for i, c in enumerate(df.columns)])
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("blank")) for i, c in enumerate(df.columns)])
    out = stats.select("rows", "unique_ids", (F.col("rows") - F.col("unique_ids")).alias("duplicate_ids"), F.explode(each).alias("c"))
    return out.select("c.column", "rows", "unique_ids", "duplicate_ids", "c.blank", F.when(F.col("rows") > 0, F.round(F.col("blank") / F.col("rows"), 6)).otherwise(0.0).alias("blank_share"))


def compare_columns(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    x, y = set(a.columns), set(b.columns)
    return {"common": sorted(x & y), "only_a": sorted(x - y), "only_b": sorted(y - x)}


def last_pairs(df: DataFrame, order: str = "position") -> DataFrame:
    """(item_id_A, item_id_B): the last pair of each A by the order column (see sources.catalog.read_pairs), pairs with a blank id left out.  Of rows without that column, or at one place, the largest B."""
    rows = df.where(~blank(F.col("item_id_A")) & ~blank(F.col("item_id_B"))).select(F.trim(F.col("item_id_A").cast("string")).alias("item_id_A"), F.trim(F.col("item_id_B").cast("string")).alias("item_id_B"), *([order] if order in df.columns else []))
    place = F.struct(order, "item_id_B") if order in df.columns else F.col("item_id_B")
    return rows.groupBy("item_id_A").agg(F.max_by("item_id_B", place).alias("item_id_B"))


def pair_diff(left: DataFrame, right: DataFrame, order: str = "position") -> DataFrame:
    """One row of counts over two sets of (item_id_A, item_id_B), the last of each A: same, changed, added, removed, and the pairs' Jaccard (1 if both are empty)."""
    both = last_pairs(left, order).withColumnRenamed("item_id_B", "l").join(last_pairs(right, order).withColumnRenamed("item_id_B", "r"), "item_id_A", "full_outer")
    same, l, r = F.col("l") == F.col("r"), F.col("l"), F.col("r")
    n = both.agg(
        F.count_if(same).alias("same"), F.count_if(l != r).alias("changed"), F.count_if(l.isNull()).alias("added"), F.count_if(r.isNull()).alias("removed"), F.count("l").alias("left"), F.count("r").alias("right"),
    )
    union = F.col("left") + F.col("right") - F.col("same")
    return n.select("same", "changed", "added", "removed", F.when(union == 0, 1.0).otherwise(F.round(F.col("same") / union, 6)).alias("jaccard"))


def with_overrides(rows: DataFrame, overrides: DataFrame, key: str = "row_key") -> DataFrame:
    """rows with each row replaced whole by the override of its key."""
    columns = [c for c in rows.columns if c != key]
    whole = overrides.select(key, F.struct(*columns).alias("__o"))
    pick = [F.when(F.col("__o").isNotNull(), F.col("__o")[c]).otherwise(F.col(c)).alias(c) for c in columns]
    return rows.join(whole, key, "left").select(key, *pick)


def review_queue(verdicts: DataFrame, per_batch: int = 400, most: int = 12_000, batch_col: str | None = None) -> DataFrame:
    """Rows under review worth a closer look, by priority then key text descending: the best of each batch, then the best of all."""
    c = F.col
    known_bad = (c("quantity_similarity") > 0) & (c("quantity_similarity") < 0.72)
    rows = verdicts.where(
        (c("final_verdict") == "REVIEW") & ~c("hard_veto") & c("brand_policy").isin("SAME", "SAME_INFERRED", "PRIVATE", "COMMODITY") & ~known_bad
        & (c("nonmatch_confidence") < 0.35) & (c("pair_support_score") >= 0.055) & (c("functional_identity_similarity") >= 0.48)
    )
    priority = M.queue_priority(c("pair_support_score"), c("match_evidence_score"), c("functional_identity_similarity"), c("nonmatch_confidence"), c("final_verdict"), c("brand_policy"))
    rows = rows.withColumn("priority", F.round(priority, 9))
    order = (F.desc("priority"), F.col("row_key").cast("string").desc())
    if batch_col:
        rows = rows.withColumn("__n", F.row_number().over(Window.partitionBy(batch_col).orderBy(*order))).where(F.col("__n") <= per_batch).drop("__n")
    return rows.orderBy(*order).limit(most)


def summary(verdicts: DataFrame, least: int = 4000) -> DataFrame:
    """One row: totals by verdict and whether the least number of matches is reached."""
    n = lambda v: F.count_if(F.col("final_verdict") == v)
    return verdicts.agg(F.count("*").alias("rows"), n("MATCH").alias("matches"), n("REVIEW").alias("reviews"), n("NON_MATCH").alias("non_matches"), (n("MATCH") >= least).alias("enough"))


def lookup(df: DataFrame, query: str, id_col: str = "item_id", name_col: str = "name") -> DataFrame:
    """The row of that id, or up to ten whose name contains the text."""
    exact = F.col(id_col) == query
    found = df.where(exact | F.contains(F.lower(name_col), F.lit(query.lower()))).withColumn("__e", exact)
    return found.orderBy(F.desc("__e"), id_col).limit(10).drop("__e")
