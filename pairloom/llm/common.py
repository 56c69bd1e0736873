"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch: a batch of long documents still fits a worker.
BATCH_ROWS = 512
#: Tables of more rows are joined by a shuffle, however small Spark takes them to be.
BROADCAST_ROWS = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or the checkpoint folder set on the context; a temporary one only in local mode."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='pairloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def sent(spark: SparkSession, thing: Any) -> Callable[[], Any]:
    """A function that gives a task the same thing, whose attributes (plain data) are broadcast; its class travels by value, so executors need no copy of this package."""
    kind, held = type(thing), spark.sparkContext.broadcast(vars(thing))

    def get() -> Any:
        out = kind.__new__(kind)
        vars(out).update(held.value)
        return out

    return get


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there and any executor can read it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pairloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables of one step, deleted together once what was made of them is written."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.path, self.count = spark, f"{shared_dir(spark)}/pairloom/{uuid.uuid4().hex}", 0

    def written(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.path}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        freed(self.spark)


def shuffled(df: DataFrame) -> DataFrame:
    """df, to be joined by a shuffle: Spark sizes a table by its compressed files and takes an explode to add no rows, so it may broadcast far more than the driver holds."""
    return df.hint("merge")


def counted(df: DataFrame) -> DataFrame:
    """df, a written table: one of more than BROADCAST_ROWS rows is never broadcast."""
    return df if df.count() <= BROADCAST_ROWS else shuffled(df)


def freed(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of what is written by now."""
    spark.sparkContext._jvm.System.gc()


def crc_mod(id_col: str, n: int):
    """crc32 of the id as decimal text, modulo n; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); component is the smallest node.

    Alternating large-star and small-star rounds.  The number of rounds grows with the logarithm of
    the longest chain; each round is one written table, so a lost executor costs one round at most.
    """
    last = Scratch(edges.sparkSession)
    e = last.written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state, many = None, e.count() > BROADCAST_ROWS
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(shuffled(least) if many else least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        here = Scratch(edges.sparkSession)
        e = here.written(small.where("u <> v").distinct())
        last.drop()
        last = here
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 999_983)).first()
        if now == state or now[0] == 0:
            break
        state, many = now, now[0] > BROADCAST_ROWS
    nodes = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return nodes.union(roots)
