"""Secrets in texts, and how widely each is owned, with DataFrame functions only.

Spans come from two regular-expression passes over a text: the matches, and the gaps between them; running sums of
their lengths are the places, made for ``BLOCK`` matches at a time, so that a text of very many matches takes no quadratic time.  Every candidate's value is hashed, and its distinct
repositories and owners are counted over the whole corpus.  A value of many owners or in many repositories is a copied example; one of a single owner in few repositories
looks live.  A generic long token (letters and digits mixed) is a secret only if it looks live: such spans are added to the base ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Kind, pattern, group whose length counts, its least length; in the order that breaks ties.
KINDS = (
    ("assign", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: Kind of the spans that ownership adds.
GENERIC = ("owned", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}+", 0, 20)
#: From so many owners, or repositories, on a value is a copied example.
EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 10
#: Matches of a text whose places are made at once.
BLOCK = 512
#: Values in so many rows are hot, but never more than so many values; their figures are broadcast.
HOT_ROWS, HOT_VALUES = 10_000, 10_000


def _spans(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """array<struct<start, rank, end, kind, value>> of the pattern's matches; places in code points, end exclusive."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")
    zipped = F.arrays_zip(F.transform(F.slice(gaps, 1, F.size(hits)), F.length).alias("gap"), F.transform(hits, F.length).alias("long"), values.alias("value"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["long"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(F.length(x["value"]) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def block(acc: Column, part: Column) -> Column:
        long = F.aggregate(part, F.lit(0), lambda n, x: n + x["gap"] + x["long"])
        return F.struct((acc["at"] + long).alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("at"), part.alias("part")))).alias("out"))

    kind_of = "array<struct<at:int,part:array<struct<gap:int,long:int,value:string>>>>"
    placed = F.aggregate(_blocks(zipped), F.struct(F.lit(0).alias("at"), F.array().cast(kind_of).alias("out")), block, lambda acc: acc["out"])
    found = F.flatten(F.transform(placed, lambda x: F.aggregate(x["part"], F.struct(x["at"].alias("at"), none.alias("out")), step, lambda acc: acc["out"])))
    return F.when(text.rlike(pattern), found).otherwise(none)


def _blocks(items: Column) -> Column:
    """The array cut into arrays of BLOCK items; none of none."""
    starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(items, i, F.lit(BLOCK)))


def _apart(more: Column, base: Column) -> Column:
    """Spans of more that overlap none of base; both are in the order of their starts."""
    near = F.transform(_blocks(more), lambda m: F.struct(m.alias("some"), F.filter(base, lambda b: (b["start"] < F.element_at(m, -1)["end"]) & (F.element_at(m, 1)["start"] < b["end"])).alias("base")))
    return F.flatten(F.transform(near, lambda x: F.filter(x["some"], lambda m: ~F.exists(x["base"], lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def candidates(df: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = [_spans(text, i, *k) for i, k in enumerate(KINDS)]
    row = df.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("whole"), F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"), F.array_sort(F.concat(*base)).alias("base"), _spans(text, len(KINDS), *GENERIC).alias("more"),
    )
    return row.withColumn("more", _apart(F.col("more"), F.col("base")))


def spread(each: DataFrame) -> DataFrame:
    """(key, rows, owners, repos): rows with the value, its distinct owners, its distinct repositories; a repository belongs to its owner.

    Counted by key, owner and repository first, so a value of very many rows is dealt over many tasks; each shuffle gets partial sums.
    """
    by_repo = each.groupBy("key", "owner", "repo").agg(F.count("*").alias("rows"))
    by_owner = by_repo.groupBy("key", "owner").agg(F.sum("rows").alias("rows"), F.count("*").alias("repos"))
    return by_owner.groupBy("key").agg(F.sum("rows").alias("rows"), F.count("*").alias("owners"), F.sum("repos").alias("repos"))


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source", example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """One row per input row: id, base and spans (arrays of spans with their kind), n_live, n_example, n_repos (longs).

    n_live: spans whose value has one owner in the whole corpus and fewer than example_repos repositories; n_example: those with example_owners or example_repos or
    more; n_repos: the most repositories that any value of the row is in, zero without spans.
    Null texts are empty and have no spans; null repositories and owners are one of their own; null ids and repeated rows stay; other columns take no part.
    """
    rows = written(candidates(df, id_col, text_col, repo_col, owner_col))
    each = written(rows.select("id", "whole", "repo", "owner", F.explode(F.concat("base", "more")).alias("span")).withColumn("key", F.sha2(F.col("span.value"), 256)))
    known = written(spread(each))
    # A value in very many rows would send them all to one task of the join.
    n = each.count()
    hot = F.col("rows") >= max(HOT_ROWS, -(-n // HOT_VALUES))
    one = each.select("id", "whole", "span", "key").distinct()
    often = F.broadcast(known.where(hot))
    joined = one.join(often, "key").unionByName(one.join(often.select("key"), "key", "left_anti").join(known.where(~hot), "key"))
    live = (F.col("owners") == 1) & (F.col("repos") < example_repos)
    example = (F.col("owners") >= example_owners) | (F.col("repos") >= example_repos)
    by_row = joined.where((F.col("span.rank") < len(KINDS)) | live).groupBy("id", "whole").agg(
        F.array_sort(F.collect_list("span")).alias("spans"), F.count_if(live).alias("n_live"), F.count_if(example).alias("n_example"), F.max("repos").alias("n_repos"),
    )
    by_row = by_row.select(F.col("id").alias("__id"), F.col("whole").alias("__whole"), "spans", "n_live", "n_example", "n_repos")
    out = rows.join(by_row, rows["id"].eqNullSafe(F.col("__id")) & (rows["whole"] == F.col("__whole")), "left")
    zero = F.lit(0).cast("long")
    return out.select("id", "base", F.coalesce("spans", "base").alias("spans"), *[F.coalesce(c, zero).alias(c) for c in ("n_live", "n_example", "n_repos")])


def _count(rank: int) -> Column:
    return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")


def secrets_digest(found: DataFrame) -> DataFrame:
    """doc_id, counts by kind, base_sha256, spans (text), n_live, n_example, n_repos."""
    count = [_count(i).alias(f"n_{k[0]}") for i, k in enumerate(KINDS)]
    return found.select(F.col("id").alias("doc_id"), *count, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), "n_live", "n_example", "n_repos")
