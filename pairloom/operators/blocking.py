"""Candidate retrieval: blocking joins instead of a cross product, then top-k per row.

Weights are whole micro-units, so sums don't depend on their order.  Every ranking names its tie-break.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

if TYPE_CHECKING:
    from . import index

# Fixed values.
RARE, RARE_PRIVATE = 4, 6
POOL = TOP = 20
FLOOR = 3.2
DEEP, DEEP_CAP = 3, 5
LARGE_BRAND = 600
MICRO = 1_000_000
W_RARE, W_NUMBER, W_EXACT, W_BRAND, W_BRAND_TOKEN, W_PRIVATE = 1.8, 1.2, 10.0, 1.2, 0.12, 0.9


def micro(c: Column) -> Column:
    return F.round(c * MICRO).cast("bigint")


def features(df: DataFrame, key: str, unicode: bool = True) -> DataFrame:
    """(key, item_id, title, brand, core, nums[, inferred]) of a catalog."""
    more = [F.col("inferred")] if "inferred" in df.columns else []
    base = df.select(key, "item_id", T.norm(F.col("name"), unicode).alias("title"), T.norm(F.col("brand_raw"), unicode).alias("brand"), T.norm(F.col("sizing_comp"), unicode).alias("__s"), *more)
    return base.select(key, "item_id", "title", "brand", T.core_tokens(F.col("title"), F.col("brand")).alias("core"), T.numeric_tokens(F.col("title"), F.col("__s")).alias("nums"), *more)


def token_weights(b: DataFrame) -> DataFrame:
    """(token, df, idf) over the core tokens of the target catalog; idf is ln((N + 1) / (df + 1)) + 1."""
    n = b.agg(F.count("*").alias("n"))
    df = b.select(F.explode("core").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    return df.crossJoin(F.broadcast(n)).select("token", "df", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def weighed(rows: DataFrame, key: str, weights: DataFrame) -> DataFrame:
    """(key, tokens): array<struct<df, neg_len, token, idf>> sorted rarest first; a token that the target lacks has df null, weight 1 and comes last."""
    each = rows.select(key, F.explode("core").alias("token")).join(weights, "token", "left")
    one = F.struct(F.coalesce("df", F.lit(2**62)).alias("df"), (-F.length("token")).alias("neg_len"), "token", F.coalesce("idf", F.lit(1.0)).alias("idf"))
    return each.groupBy(key).agg(F.array_sort(F.collect_list(one)).alias("tokens"))


def rare_tokens(tokens: Column, n: int) -> Column:
    return F.slice(F.filter(tokens, lambda t: t["df"] < 2**62), 1, n)


def channels(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows (a, b, kind, w): what each blocking channel adds to a pair.  a has tokens beside its features; b too."""
    post = b.select("b_index", F.explode("core").alias("token"), F.col("brand").alias("brand_b"))
    rare = a.select("row_key", "brand", F.explode(rare_tokens(F.col("tokens"), RARE)).alias("t")).select("row_key", "brand", "t.token", "t.idf").join(post, "token")
    from_rare = rare.select("row_key", "b_index", F.lit("base").alias("kind"), micro(F.col("idf") * W_RARE).alias("w"))
    nums = a.select("row_key", F.explode("nums").alias("z")).join(b.select("b_index", F.explode("nums").alias("z")), "z")
    from_nums = nums.select("row_key", "b_index", F.lit("base").alias("kind"), F.lit(int(W_NUMBER * MICRO)).cast("bigint").alias("w"))
    exact = a.select("row_key", "title").join(b.select("b_index", "title"), "title").select("row_key", "b_index", F.lit("exact").alias("kind"), F.lit(int(W_EXACT * MICRO)).cast("bigint").alias("w"))
    count = b.where("brand <> ''").groupBy("brand").agg(F.count("*").alias("n"))
    sized = a.where("brand <> ''").join(count, "brand")
    small = sized.where(F.col("n") <= LARGE_BRAND).select("row_key", "brand", "core", "nums", "tokens").join(b.select("b_index", "brand", F.col("core").alias("core_b"), F.col("nums").alias("nums_b")), "brand")
    tokens = F.coalesce("tokens", F.array().cast(a.schema["tokens"].dataType))
    shared = F.aggregate(F.filter(tokens, lambda t: F.array_contains("core_b", t["token"])), F.lit(0.0), lambda s, t: s + t["idf"])
    small = small.where(F.arrays_overlap("core", "core_b") | F.arrays_overlap("nums", "nums_b"))
    from_small = small.select("row_key", "b_index", F.lit("brand").alias("kind"), micro(W_BRAND + W_BRAND_TOKEN * shared).alias("w"))
    large = rare.where("brand = brand_b and brand <> ''").join(count.where(F.col("n") > LARGE_BRAND).select("brand"), "brand", "left_semi")
    from_large = large.select("row_key", "b_index", F.lit("brand").alias("kind"), F.lit(int(W_BRAND * MICRO)).cast("bigint").alias("w"))
    private = a.where(F.col("brand").isin(*T.LABELS_A) & ~F.col("brand").isin(*T.LABELS_B)).select("row_key", F.explode(rare_tokens(F.col("tokens"), RARE_PRIVATE)).alias("t"))
    private = private.select("row_key", "t.token", "t.idf").join(post.where(F.col("brand_b").isin(*T.LABELS_B)), "token")
    from_private = private.select("row_key", "b_index", F.lit("private").alias("kind"), micro(F.col("idf") * W_PRIVATE).alias("w"))
    return from_rare.union(from_nums).union(exact).union(from_small).union(from_large).union(from_private)


def channel_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every pair (row_key, b_index) that some channel joins."""
    return channels(a, b).select("row_key", "b_index").distinct()


def _mass(tokens: Column) -> Column:
    return F.aggregate(tokens, F.lit(0.0), lambda s, t: s + t["idf"])


def _micros(tokens: Column, weight: float) -> Column:
    return F.aggregate(tokens, F.lit(0).cast("bigint"), lambda s, t: s + micro(t["idf"] * weight))


def scored(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs with what all channels add to them (acc, base, protected, by_brand, by_private) and their retrieval scores, one row for each, from the features of both.

    Score: 3.2 weighted Jaccard + 1.8 containment + brand + 0.6 numbers + 4 exact title, + 1 for a private-label pair.  a has n_brand beside its features.
    """
    none = lambda df: F.coalesce("tokens", F.array().cast(df.schema["tokens"].dataType))
    left = a.select("row_key", F.col("title").alias("ta"), F.col("brand").alias("ba"), F.col("core").alias("ca"), F.col("nums").alias("na"), none(a).alias("wa"), "inferred", "n_brand")
    right = b.select("b_index", F.col("item_id").alias("item_id_B"), F.col("title").alias("tb"), F.col("brand").alias("bb"), F.col("core").alias("cb"), F.col("nums").alias("nb"), none(b).alias("wb"))
    pair = pairs.join(left, "row_key").join(right, "b_index")
    shared = lambda tokens: F.filter(tokens, lambda t: F.array_contains("cb", t["token"]))
    pair = pair.select("*", _mass(shared(F.col("wa"))).alias("wi"), _mass(F.col("wa")).alias("aw"), _mass(F.col("wb")).alias("bw"), shared(rare_tokens(F.col("wa"), RARE)).alias("rare"))
    one = lambda c: F.when(c == 0, 1.0).otherwise(c)
    flag = lambda c: c.cast("double")
    zero = F.lit(0).cast("bigint")
    exact = F.col("ta") == F.col("tb")
    same = (F.col("ba") != "") & (F.col("ba") == F.col("bb"))
    small = same & (F.col("n_brand") <= LARGE_BRAND) & (F.arrays_overlap("ca", "cb") | F.arrays_overlap("na", "nb"))
    large = same & (F.col("n_brand") > LARGE_BRAND) & (F.size("rare") > 0)
    label = F.col("ba").isin(*T.LABELS_A) & ~F.col("ba").isin(*T.LABELS_B) & F.col("bb").isin(*T.LABELS_B)
    by_private = label & (F.size(shared(rare_tokens(F.col("wa"), RARE_PRIVATE))) > 0)
    base = _micros(F.col("rare"), W_RARE) + F.size(F.array_intersect("na", "nb")) * F.lit(int(W_NUMBER * MICRO)) + F.when(exact, int(W_EXACT * MICRO)).otherwise(0)
    brand = F.when(small, micro(W_BRAND + W_BRAND_TOKEN * F.col("wi"))).when(large, F.size("rare") * F.lit(int(W_BRAND * MICRO))).otherwise(zero)
    private = F.when(by_private, _micros(shared(rare_tokens(F.col("wa"), RARE_PRIVATE)), W_PRIVATE)).otherwise(zero)
    similar = F.col("wi") / one(F.col("aw") + F.col("bw") - F.col("wi"))
    contain = F.col("wi") / F.least(one(F.col("aw")), one(F.col("bw")))
    both = F.col("ba").isin(*T.LABELS_A) & F.col("bb").isin(*T.LABELS_B)
    numbers = F.when((F.size("na") > 0) & (F.col("na") == F.col("nb")), 1.0).when(F.arrays_overlap("na", "nb"), 0.5).otherwise(0.0)
    score = 3.2 * similar + 1.8 * contain + flag(same) + 0.6 * numbers + 4.0 * flag(exact)
    return pair.select(
        "row_key", "b_index", "item_id_B", "inferred", base.cast("bigint").alias("base"), (base + brand + private).cast("bigint").alias("acc"), exact.alias("protected"), (small | large).alias("by_brand"), by_private.alias("by_private"),
        same.alias("same"), both.alias("private"), score.alias("base_score"), (score + flag(both)).alias("score"),
    ).where("acc > 0")


def ranked(pairs: DataFrame) -> DataFrame:
    """Ranked candidates of each row: the POOL best of scored pairs by acc, ties to the smaller b_index, ranked by score."""
    first = Window.partitionBy("row_key").orderBy(F.desc("base"), "b_index")
    best = Window.partitionBy("row_key").orderBy(F.desc("acc"), "b_index")
    early = (F.row_number().over(first) <= POOL) & (F.col("base") > 0)
    pool = pairs.withColumn("early", early).withColumn("n", F.row_number().over(best)).where(F.col("n") <= POOL)
    rescue = (
        F.when(F.col("private") & ((F.col("by_private") & ~F.col("early")) | (F.col("inferred") == "PRIVATE_LABEL")), "PRIVATE_LABEL")
        .when(F.col("same") & ((F.col("by_brand") & ~F.col("early")) | (F.col("inferred") == "PACK_PREFIX_BRAND")), "SAME_BRAND")
        .otherwise("")
    )
    rank = F.row_number().over(Window.partitionBy("row_key").orderBy(F.desc(F.round("score", 9)), "b_index"))
    return pool.select(
        "row_key", "item_id_B", "b_index", rank.alias("retrieval_rank"), F.round("score", 6).alias("retrieval_score"), F.round("base_score", 6).alias("base_retrieval_score"),
        rescue.alias("retrieval_rescue_type"), "protected",
    ).where(F.col("retrieval_rank") <= TOP)


def prepared(a: DataFrame, b: DataFrame, unicode: bool = True) -> tuple[DataFrame, DataFrame]:
    """Features with weighed tokens of both catalogs."""
    fa, fb = features(a, "row_key", unicode), features(b, "b_index", unicode)
    if "inferred" not in fa.columns:
        fa = fa.withColumn("inferred", F.lit(""))
    weights = token_weights(fb)
    return fa.join(weighed(fa, "row_key", weights), "row_key", "left"), fb.join(weighed(fb, "b_index", weights), "b_index", "left")


def prepared_rows(fa: DataFrame, target: index.Target) -> DataFrame:
    """Features of the source catalog with weighed tokens and n_brand, the number of the target's rows of its brand."""
    return fa.join(weighed(fa, "row_key", target.weights), "row_key", "left").join(target.brands, "brand", "left")


def alike(fa: DataFrame) -> DataFrame:
    """(row_key, like): for each row the smallest row_key of those with equal features, which have the same candidates."""
    by = [c for c in fa.columns if c not in ("row_key", "item_id")]
    least = fa.groupBy(*by).agg(F.min("row_key").alias("like"))
    same = F.lit(True)
    for c in by:
        same &= fa[c].eqNullSafe(least[c])
    return fa.join(least, same).select("row_key", "like")


def retrieve(a: DataFrame, b: DataFrame | None, unicode: bool = True, stored: index.Target | None = None) -> DataFrame:
    """Up to TOP ranked candidates of b for each row of a, from proposals that hold every pair which can be among them (see topk).

    Rows with equal features are searched once.  stored: the tables of b where they were stored before (see index); b isn't read then.
    """
    from ..plans.stages import Folder
    from . import index, topk

    folder = Folder(a.sparkSession)
    target = stored or index.of(b, unicode, lambda _, df: folder.staged(df))
    every = features(a, "row_key", unicode)
    every = folder.staged(every if "inferred" in every.columns else every.withColumn("inferred", F.lit("")))
    like = folder.staged(alike(every))
    fa = folder.staged(prepared_rows(every.join(like.where("row_key = like").select("row_key"), "row_key", "left_semi"), target))
    # The rows are few bytes but much work: they stay in as many tasks as the session asks for.
    pairs = topk.proposals(fa, target, folder).repartition(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), "row_key")
    found = folder.staged(ranked(scored(folder.staged(pairs), fa, target.features)))
    out = folder.result(like.join(found.withColumnRenamed("row_key", "like"), "like").drop("like").select(*found.columns))
    folder.drop()
    return out


def deep_shortlist(candidates: DataFrame) -> DataFrame:
    """The DEEP best, then protected ones (one for each item id) up to DEEP_CAP in all."""
    item = Window.partitionBy("row_key", "item_id_B").orderBy("retrieval_rank")
    early = F.col("retrieval_rank") <= DEEP
    kept = candidates.withColumn("__n", F.row_number().over(item)).where(early | (F.col("protected") & (F.col("__n") == 1)))
    place = F.row_number().over(Window.partitionBy("row_key").orderBy("retrieval_rank"))
    return kept.withColumn("__p", place).where(F.col("__p") <= DEEP_CAP).drop("__n", "__p")


def weak_rows(a: DataFrame, candidates: DataFrame, floor: float = FLOOR) -> DataFrame:
    """Rows of a without a candidate of that score: (row_key, item_id, decision_reason)."""
    strong = candidates.where((F.col("retrieval_rank") == 1) & (F.col("retrieval_score") >= floor))
    return a.join(strong.select("row_key"), "row_key", "left_anti").select("row_key", "item_id", F.lit("WEAK_RETRIEVAL_NONMATCH").alias("decision_reason"))


def infer_brands(a: DataFrame, b: DataFrame) -> DataFrame:
    """a with brand_raw and inferred filled where the brand is blank: a private label or a brand of b that starts the title, pack wrappers aside.

    Brands of b meet titles on their first word; the longest that starts the title wins.
    """
    title, lead = T.bare(F.col("name")), T.bare(F.col("name"))
    for _ in range(2):
        lead = F.trim(F.regexp_replace(lead, r"^(?:\d+\s*(?:x|pack|pk)\s+|pack\s+of\s+\d+\s+|\d+\s+pack\s+of\s+)", ""))
    blank = (T.bare(F.col("brand_raw")) == "") & (title != "")
    rows = a.withColumn("__lead", lead).withColumn("__title", title).withColumn("__blank", blank)
    begins = lambda p: (F.col("__lead") == p) | F.col("__lead").startswith(F.concat(p, F.lit(" ")))
    labels = sorted(set((*T.LABELS_A, *T.LABELS_B)), key=lambda p: (-len(p), p))
    label = F.coalesce(*[F.when(begins(F.lit(p)), p) for p in labels])
    brands = b.select(T.norm(F.col("brand_raw"), False).alias("brand")).where("brand <> ''").distinct().withColumn("bare", T.bare(F.col("brand")))
    first = brands.select("brand", "bare", F.explode(F.array_distinct(F.array(F.split("brand", " ")[0], F.split("bare", " ")[0]))).alias("first"))
    asked = rows.where("__blank").select("row_key", "__lead", F.split("__lead", " ")[0].alias("first"))
    found = asked.join(first, "first").where(begins(F.col("bare"))).groupBy("row_key").agg(F.min_by("brand", F.struct(-F.length("brand"), "brand")).alias("__brand"))
    rows = rows.join(found, "row_key", "left").withColumn("__label", F.when(F.col("__blank"), label))
    inferred = F.when(F.col("__label").isNotNull(), "PRIVATE_LABEL").when(F.col("__brand").isNotNull(), F.when(F.col("__lead") != F.col("__title"), "PACK_PREFIX_BRAND").otherwise("TITLE_BRAND")).otherwise("")
    rows = rows.withColumn("inferred", inferred).withColumn("brand_raw", F.coalesce("__label", "__brand", "brand_raw"))
    return rows.drop("__lead", "__title", "__blank", "__brand", "__label")
