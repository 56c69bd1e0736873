"""The target catalog as stored tables, made once and read by every later run without moving their rows.

Each table is bucketed by what later joins ask for, so only the other side of a join is shuffled: features by b_index, postings by key, by key and brand and by
two keys, titles by title.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import blocking as B


@dataclass(frozen=True)
class Target:
    """What retrieval reads of the target catalog, see of()."""

    features: DataFrame
    weights: DataFrame
    counts: DataFrame
    brands: DataFrame
    postings: DataFrame
    branded: DataFrame
    twos: DataFrame
    titles: DataFrame


#: Tables and the columns by which each is bucketed.
TABLES = {"features": ("b_index",), "weights": ("token",), "counts": ("key",), "brands": ("brand",), "postings": ("key",), "branded": ("key", "brand"), "twos": ("x", "y"), "titles": ("title",)}


def of(b: DataFrame, unicode: bool = True, stored=lambda name, df: df) -> Target:
    """The tables of a catalog.  stored: keeps a table that others are made from.

    features: see blocking.features, with weighed tokens.  weights: (token, df, idf).  postings: (key, b_index, brand, place, own), keys as in token_key and number_key, with counts (key, n);
    branded: those with a brand.  place and own number the rows with equal keys, and with equal keys and brand, by b_index.  brands: (brand, n_brand).
    twos: (x, y, brand, keys, held) for every two keys, x < y, once for all rows with equal keys and brand; held: b_index and early (place is POOL at most) of the POOL smallest.
    titles: (title, b_index, brand, place, own), the last two counted within the title.
    """
    plain = stored("plain", B.features(b, "b_index", unicode))
    weights = stored("weights", B.token_weights(plain))
    features = stored("features", plain.join(B.weighed(plain, "b_index", weights), "b_index", "left"))
    keyed = features.select("b_index", "brand", "title", F.array_sort(F.concat(F.transform("core", token_key), F.transform("nums", number_key))).alias("keys"))
    number = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("b_index"))
    placed = stored("placed", keyed.withColumns({"place": number("keys"), "own": number("keys", "brand")}))
    postings = placed.select(F.explode("keys").alias("key"), "b_index", "brand", "place", "own")
    pairs = F.flatten(F.transform("keys", lambda x, i: F.transform(F.slice("keys", i + 2, F.size("keys")), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    kinds = placed.where((F.size("keys") > 1) & (F.col("own") <= B.POOL)).groupBy("keys", "brand").agg(F.array_sort(F.collect_list(F.struct("b_index", (F.col("place") <= B.POOL).alias("early")))).alias("held"))
    twos = kinds.select(F.explode(pairs).alias("p"), "brand", "keys", "held").select("p.x", "p.y", "brand", "keys", "held")
    titles = keyed.select("title", "b_index", "brand", number("title", "keys").alias("place"), number("title", "keys", "brand").alias("own"))
    brands = features.where("brand <> ''").groupBy("brand").agg(F.count("*").alias("n_brand"))
    return Target(features, weights, postings.groupBy("key").agg(F.count("*").alias("n")), brands, postings, postings.where("brand <> ''"), twos, titles)


def token_key(token):
    return F.concat(F.lit("t:"), token)


def number_key(z):
    return F.concat(F.lit("n:"), z)


def build(b: DataFrame, name: str, path: str, buckets: int = 64, unicode: bool = True) -> Target:
    """Stores the tables of a catalog as name_features and so on, under a path that all executors share; a table of that name is replaced."""
    from ..plans.stages import Folder

    spark = b.sparkSession
    folder = Folder(spark)

    def store(table: str, df: DataFrame) -> DataFrame:
        by = TABLES[table]
        df.write.mode("overwrite").option("path", f"{path}/{table}").bucketBy(buckets, *by).sortBy(*by).saveAsTable(f"{name}_{table}")
        return spark.table(f"{name}_{table}")

    made = of(b, unicode, lambda table, df: store(table, df) if table in TABLES else folder.staged(df))
    for table in TABLES:
        if table not in ("features", "weights"):
            store(table, getattr(made, table))
    folder.drop()
    return opened(spark, name)


def opened(spark: SparkSession, name: str) -> Target:
    """The stored tables of that name."""
    return Target(**{t: spark.table(f"{name}_{t}") for t in TABLES})
