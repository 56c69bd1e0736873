"""Proposals for the best candidates of each row: every pair that can be among the POOL best, and few others.

What channels add to a pair is a sum over keys: a row's rarest tokens and its numbers (its base), and more for an equal brand, a private label or an equal title.
Rows with the same keys are one class, searched once.  For a set S of keys let first(S) be the POOL smallest b_index whose keys hold all of S.  A
candidate with just the keys X of a class can be among the POOL best by base only if it is in first(X): otherwise POOL candidates with at least X come before it.
So the lists first(S) of a class's sets S give its best candidates; sets that weigh less than one known to hold POOL candidates are left out.
Long lists are never paired with rows: single keys give their first rows only, two keys are joined as one, and larger sets look through the list of their two rarest keys.
Candidates with equal keys (and an equal brand, where it counts) add the same to any row, an equal title aside, so lists hold the POOL first of them only.

The POOL-th best base of a class is a bound for its rows.  A candidate of the same brand, or another private label, needs it too: as what that can add is bounded, some keys
can't be missing, and candidates are joined on brand and such keys.  A large brand adds to each shared token alike: its candidates are searched as all are, each class within each brand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import blocking as B
from .index import Target, number_key, token_key

#: Sets are made of at most so many keys; rows with more (five numbers and up) take every pair that a channel joins.
MOST_KEYS = 8
_SEP = "\x01"
_KEY = "struct<n:bigint,key:string,w:bigint>"


def keyed_rows(a: DataFrame, counts: DataFrame) -> DataFrame:
    """(row_key, keys, class): keys of a's rows rarest first, those that the target lacks left out."""
    rare = F.transform(B.rare_tokens(F.coalesce("tokens", F.array().cast(a.schema["tokens"].dataType)), B.RARE), lambda t: F.struct(token_key(t["token"]).alias("key"), B.micro(t["idf"] * B.W_RARE).alias("w")))
    nums = F.transform("nums", lambda z: F.struct(number_key(z).alias("key"), F.lit(int(B.W_NUMBER * B.MICRO)).cast("bigint").alias("w")))
    each = a.select("row_key", F.explode(F.concat(rare, nums)).alias("k")).select("row_key", "k.key", "k.w").join(counts, "key")
    rows = each.groupBy("row_key").agg(F.array_sort(F.collect_list(F.struct("n", "key", "w"))).alias("keys"))
    return rows.withColumn("class", F.array_join(F.transform("keys", lambda k: k["key"]), _SEP))


def subsets(classes: DataFrame) -> DataFrame:
    """(class, key, ks, size, w), and brand if classes have it: all sets of one key and more of each class, keys in the class's order."""
    none = F.array(F.struct(F.array().cast("array<string>").alias("ks"), F.lit(0).cast("bigint").alias("w")))
    more = F.aggregate("keys", none, lambda sets, k: F.concat(sets, F.transform(sets, lambda s: F.struct(F.concat(s["ks"], F.array(k["key"])).alias("ks"), (s["w"] + k["w"]).alias("w")))))
    own = [c for c in classes.columns if c != "keys"]
    each = classes.select(*own, F.explode(more).alias("s")).select(*own, "s.ks", "s.w", F.size("s.ks").alias("size")).where("size > 0")
    return each.withColumn("key", F.array_join("ks", _SEP))


def _first(rows: DataFrame, by: list[str]) -> DataFrame:
    """(key, b_index), and brand if by names it, of the POOL smallest b_index of each key."""
    place = F.row_number().over(Window.partitionBy("key", *by).orderBy("b_index"))
    return rows.select("key", *by, "b_index").withColumn("n", place).where(F.col("n") <= B.POOL).drop("n")


def pair_postings(twos: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, brand, keys, held): candidates of every two keys of the classes, which come in their class's order."""
    pairs = F.flatten(F.transform("keys", lambda x, i: F.transform(F.slice("keys", i + 2, F.size("keys")), lambda y: F.struct(x["key"].alias("k1"), y["key"].alias("k2")))))
    wanted = classes.select(F.explode(pairs).alias("p")).select("p.k1", "p.k2").distinct()
    asked = wanted.select(F.concat_ws(_SEP, "k1", "k2").alias("key"), F.least("k1", "k2").alias("x"), F.greatest("k1", "k2").alias("y"))
    return twos.join(asked, ["x", "y"]).select("key", "brand", "keys", "held")


def best_of_classes(classes: DataFrame, postings: DataFrame, twos: DataFrame, folder) -> DataFrame:
    """(class, b_index, base) of the POOL best of each class, and brand if classes have it: then each class is searched within its brand.

    postings: (key, b_index), twos: (key, keys, bs), both with brand if classes have it.
    """
    by = [c for c in ("brand",) if c in classes.columns]
    key = ["key", *by]
    sets = folder.staged(subsets(classes))
    asked = sets.where("size = 1").select(*key).distinct()
    firsts = folder.staged(_first(postings.join(asked, key, "left_semi"), by).union(_first(twos.select(*key, F.explode("bs").alias("b_index")), by)))
    full = firsts.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") >= B.POOL).select(*key)
    bound = sets.join(full, key, "left_semi").groupBy("class", *by).agg(F.max("w").alias("bound"))
    useful = folder.staged(sets.join(bound, ["class", *by], "left").where("w >= coalesce(bound, 0)").drop("bound"))
    large = useful.where("size > 2").select(*key, "ks").distinct()
    large = large.select(F.col("key").alias("whole"), *by, F.concat_ws(_SEP, F.slice("ks", 1, 2)).alias("key"), F.slice("ks", 3, MOST_KEYS).alias("rest"))
    found = large.join(twos, key).where(F.forall("rest", lambda k: F.array_contains("keys", k)))
    firsts = firsts.union(_first(found.select(F.col("whole").alias("key"), *by, F.explode("bs").alias("b_index")), by))
    best = useful.select("class", *key, "w").join(firsts, key).groupBy("class", *by, "b_index").agg(F.max("w").alias("base"))
    place = F.row_number().over(Window.partitionBy("class", *by).orderBy(F.desc("base"), "b_index"))
    return folder.staged(best.withColumn("n", place).where(F.col("n") <= B.POOL).drop("n"))


def needed(rows: DataFrame) -> DataFrame:
    """rows (keys, least, ...) with what a candidate whose keys weigh at least that much needs: two (a set of two keys it must hold, or null) and any (keys of which it must hold one).

    Of several ways the one with the rarest keys: two keys that can't be missing, one such key, or the rarest keys beside those that are too light together.  Nothing is needed where least is 0 or less: both are null.
    """
    total = F.aggregate("keys", F.lit(0).cast("bigint"), lambda s, k: s + k["w"])
    rows = rows.withColumn("must", F.filter("keys", lambda k: total - k["w"] < F.col("least")))
    # Keys from the commonest on whose weights stay below least may all be missing.
    light = F.aggregate(
        F.reverse("keys"),
        F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("n"), F.lit(False).alias("over")),
        lambda s, k: F.when(s["over"] | (s["sum"] + k["w"] >= F.col("least")), F.struct(s["sum"].alias("sum"), s["n"].alias("n"), F.lit(True).alias("over"))).otherwise(F.struct((s["sum"] + k["w"]).alias("sum"), (s["n"] + 1).alias("n"), F.lit(False).alias("over"))),
    )["n"]
    name = lambda ks: F.transform(ks, lambda k: k["key"])
    two = F.when((F.col("least") > 0) & (F.size("must") > 1), F.array_join(F.slice(name(F.col("must")), 1, 2), _SEP))
    some = F.when(F.size("must") > 0, name(F.slice("must", 1, 1))).otherwise(name(F.slice("keys", 1, F.greatest(F.lit(0), F.size("keys") - light))))
    return rows.withColumn("two", two).withColumn("any", F.when((F.col("least") > 0) & F.col("two").isNull(), some)).drop("must")


def by_brand(a: DataFrame, left: DataFrame, target: Target, twos: DataFrame, bounds: DataFrame) -> DataFrame:
    """(row_key, b_index) of candidates of the row's brand, one of LARGE_BRAND rows at most, that may reach its class's bound."""
    idf = F.aggregate(F.filter(F.coalesce("tokens", F.array().cast(a.schema["tokens"].dataType)), lambda t: t["df"] < 2**62), F.lit(0.0), lambda s, t: s + t["idf"])
    most = B.micro(B.W_BRAND + B.W_BRAND_TOKEN * idf) + 1
    every = F.concat(F.transform("core", token_key), F.transform("nums", number_key))
    rows = a.where((F.col("brand") != "") & (F.col("n_brand") <= B.LARGE_BRAND)).select("row_key", "brand", most.alias("most"), every.alias("every"))
    rows = rows.join(left, "row_key", "left").join(bounds, "class", "left")
    rows = needed(rows.withColumn("keys", F.coalesce("keys", F.array().cast(f"array<{_KEY}>"))).withColumn("least", F.coalesce("bound", F.lit(0)) - F.col("most")))
    pairs = rows.where("two is not null").select("row_key", "brand", F.col("two").alias("key")).join(twos.select("key", "brand", "held"), ["key", "brand"])
    single = rows.where("two is null").select("row_key", "brand", F.explode(F.coalesce("any", "every")).alias("key"))
    single = single.join(_few(target.branded), ["key", "brand"])
    return pairs.select("row_key", F.explode("held.b_index").alias("b_index")).union(single.select("row_key", "b_index"))


def of_large_brands(a: DataFrame, left: DataFrame, classes: DataFrame, target: Target, twos: DataFrame, folder) -> DataFrame:
    """(row_key, b_index) of the POOL best candidates of the row's brand, one of more than LARGE_BRAND rows, by what their keys add within the brand."""
    rows = folder.staged(left.join(a.where((F.col("brand") != "") & (F.col("n_brand") > B.LARGE_BRAND)).select("row_key", "brand"), "row_key").select("row_key", "class", "brand"))
    more = F.transform("keys", lambda k: F.struct(k["n"].alias("n"), k["key"].alias("key"), (k["w"] + F.when(k["key"].startswith(token_key(F.lit(""))), int(B.W_BRAND * B.MICRO)).otherwise(0)).alias("w")))
    within = rows.select("class", "brand").distinct().join(classes, "class").select("class", "brand", more.alias("keys"))
    best = best_of_classes(within, _few(target.branded), twos.select("key", "brand", "keys", F.col("held.b_index").alias("bs")), folder)
    return rows.join(best, ["class", "brand"]).select("row_key", "b_index")


def _few(postings: DataFrame) -> DataFrame:
    return postings.where(F.col("own") <= B.POOL)


def by_label(a: DataFrame, left: DataFrame, target: Target, bounds: DataFrame) -> DataFrame:
    """(row_key, b_index) of private-label candidates that may reach the bound of a private-label row's class."""
    rows = a.where(F.col("brand").isin(*T.LABELS_A) & ~F.col("brand").isin(*T.LABELS_B))
    tokens = B.rare_tokens(F.coalesce("tokens", F.array().cast(a.schema["tokens"].dataType)), B.RARE_PRIVATE)
    weigh = lambda t, i: B.micro(t["idf"] * B.W_PRIVATE) + F.when(i < B.RARE, B.micro(t["idf"] * B.W_RARE)).otherwise(0)
    keys = F.transform(tokens, lambda t, i: F.struct(t["df"].cast("bigint").alias("n"), token_key(t["token"]).alias("key"), weigh(t, i).alias("w")))
    # Numbers count too, but a candidate without one of the tokens gets nothing for its label.
    spare = F.size("nums") * F.lit(int(B.W_NUMBER * B.MICRO))
    rows = rows.select("row_key", keys.alias("own"), spare.alias("spare")).join(left.select("row_key", "class"), "row_key", "left").join(bounds, "class", "left")
    rows = needed(rows.select("row_key", F.col("own").alias("keys"), (F.coalesce("bound", F.lit(0)) - F.col("spare")).alias("least")))
    own = F.transform("keys", lambda k: k["key"])
    any_of = F.when(F.col("two").isNotNull(), F.slice(F.split("two", _SEP), 1, 1)).otherwise(F.coalesce("any", own))
    each = rows.select("row_key", F.explode(any_of).alias("key"))
    return each.join(_few(target.postings).where(F.col("brand").isin(*T.LABELS_B)), "key").select("row_key", "b_index")


def every_pair(a: DataFrame, target: Target) -> DataFrame:
    """(row_key, b_index) of all candidates that share a rare token or a number with a row of a, or any key and the brand."""
    name = lambda tokens: F.transform(tokens, lambda t: token_key(t["token"]))
    rare = B.rare_tokens(F.coalesce("tokens", F.array().cast(a.schema["tokens"].dataType)), B.RARE_PRIVATE)
    nums = F.transform("nums", number_key)
    some = a.select("row_key", F.explode(F.concat(name(rare), nums)).alias("key")).join(_few(target.postings), "key")
    same = a.where("brand <> ''").select("row_key", "brand", F.explode(F.concat(F.transform("core", token_key), nums)).alias("key")).join(_few(target.branded), ["key", "brand"])
    return some.select("row_key", "b_index").union(same.select("row_key", "b_index"))


def of_titles(a: DataFrame, target: Target) -> DataFrame:
    """(row_key, b_index) of candidates with the row's title: the POOL first of those with equal keys, and of its brand, or of each private label if the row has one."""
    there = target.titles.where(F.col("own") <= B.POOL).withColumnRenamed("brand", "theirs")
    label = F.col("brand").isin(*T.LABELS_A) & F.col("theirs").isin(*T.LABELS_B)
    return a.select("row_key", "title", "brand").join(there, "title").where((F.col("place") <= B.POOL) | (F.col("brand") == F.col("theirs")) | label).select("row_key", "b_index")


def proposals(a: DataFrame, target: Target, folder) -> DataFrame:
    """(row_key, b_index), each once: for every row of a all candidates of the target that can be among its POOL best by what channels add or by its base part.

    a: features with tokens (blocking.weighed) and n_brand, the number of candidates of its brand.  folder keeps the tables between the steps.
    """
    left = folder.staged(keyed_rows(a, target.counts))
    wide = left.where(F.size("keys") > MOST_KEYS).select("row_key")
    left = left.where(F.size("keys") <= MOST_KEYS)
    classes = folder.staged(left.groupBy("class").agg(F.first("keys").alias("keys")))
    twos = folder.staged(pair_postings(target.twos, classes))
    early = twos.select("key", "keys", F.transform(F.filter("held", lambda x: x["early"]), lambda x: x["b_index"]).alias("bs")).where(F.size("bs") > 0)
    early = folder.staged(early.groupBy("key", "keys").agg(F.flatten(F.collect_list("bs")).alias("bs")))
    best = best_of_classes(classes, target.postings.where(F.col("place") <= B.POOL), early, folder)
    bounds = folder.staged(best.groupBy("class").agg(F.count("*").alias("n"), F.min("base").alias("bound")).where(F.col("n") >= B.POOL).drop("n"))
    narrow = a.join(wide, "row_key", "left_anti")
    pairs = left.select("row_key", "class").join(best.select("class", "b_index"), "class").select("row_key", "b_index")
    pairs = pairs.union(by_brand(narrow, left, target, twos, bounds)).union(of_large_brands(narrow, left, classes, target, twos, folder)).union(by_label(narrow, left, target, bounds))
    pairs = pairs.union(of_titles(a, target))
    pairs = pairs.union(every_pair(a.join(wide, "row_key", "left_semi"), target))
    return pairs.distinct()
