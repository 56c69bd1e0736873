"""Stage outputs as tables in the shared folder: lineage and plans end there, and a lost executor costs one stage."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new path under spark.checkpoint.dir; a temporary folder only where that is unset in local mode."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='pairloom-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/pairloom-stages/{uuid.uuid4().hex}"


@contextmanager
def unguessed(spark: SparkSession) -> Iterator[None]:
    """Within it only what a plan names is broadcast.

    Spark sizes a table by its compressed files and the columns it reads of them, and takes an explode to add no rows: keys, pairs and facts of many
    equal products are a few MB by that, and more than a driver holds once they are rows.
    """
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    held = {k: spark.conf.get(k, None) for k in names}
    try:
        for k in names:
            spark.conf.set(k, "-1")
        yield
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def staged(df: DataFrame) -> DataFrame:
    """df written to a folder of its own and read again."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Folder:
    """Tables of one operator, deleted together once its result is written elsewhere."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.path, self.count = spark, shared_folder(spark), 0

    def staged(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.path}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame) -> DataFrame:
        """df staged apart, so that it outlives the folder."""
        return staged(df)

    def drop(self) -> None:
        deleted(self.spark, self.path)


def deleted(spark: SparkSession, path: str) -> None:
    """Deletes what is under the path, wherever it is stored."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


class Run:
    """Stages of one job under a path: what is finished is read, not made again, so a job that was stopped goes on where it was.

    A path belongs to one signature, a digest of the inputs' rows and the settings, which its manifest holds; other inputs or settings are refused.  A stage
    counts as finished when Spark has committed its folder (_SUCCESS), so a stage that was cut off is made again whole.
    """

    def __init__(self, spark: SparkSession, path: str, inputs: dict[str, DataFrame], settings: object = None) -> None:
        self.spark, self.path, self.made = spark, path.rstrip("/"), []
        held = {"inputs": {k: content(df) for k, df in sorted(inputs.items())}, "settings": hashlib.sha256(repr(settings).encode()).hexdigest()}
        manifest = f"{self.path}/manifest"
        if exists(spark, f"{manifest}/_SUCCESS"):
            found = json.loads(spark.read.text(manifest).first()[0])
            if found != held:
                apart = [k for k in sorted({*found["inputs"], *held["inputs"]}) if found["inputs"].get(k) != held["inputs"].get(k)]
                raise ValueError(f"{self.path} holds a run over other {'inputs: ' + ', '.join(apart) if apart else 'settings'}")
        else:
            spark.createDataFrame([(json.dumps(held),)], "value string").coalesce(1).write.mode("overwrite").text(manifest)

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The rows of make(), which is called only if the stage isn't finished."""
        path = f"{self.path}/{name}"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            self.made.append(name)
            make().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)


def content(df: DataFrame) -> str:
    """A digest of a table's columns and rows, whatever their order; repeated rows count."""
    row = F.xxhash64(*df.columns) if df.columns else F.lit(0).cast("bigint")
    got = df.select(row.alias("h")).agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.sum(F.xxhash64("h").cast("decimal(38,0)")).alias("t")).first()
    return hashlib.sha256(repr((df.dtypes, got["n"], str(got["s"]), str(got["t"]))).encode()).hexdigest()


def exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


_MARK, _BATCH = "__content", "__batch"


def _versions(products: DataFrame, key: str, version: str) -> DataFrame:
    """products with a digest of each row's columns but its key, and of the version."""
    rest = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in sorted(products.columns) if c != key]
    return products.withColumn(_MARK, F.sha2(F.concat_ws("\x01", F.lit(version), *rest), 256))


def _done(spark: SparkSession, path: str, key: str) -> DataFrame | None:
    return spark.read.parquet(f"{path}/done") if exists(spark, f"{path}/done/_SUCCESS") else None


def cached(products: DataFrame, key: str, make: Callable[[DataFrame], DataFrame], path: str, version: str = "") -> DataFrame:
    """make(products), with its rows kept under path for later runs by key and content: only new and changed products are made, and added.

    make gives rows that carry the key; version names what else they depend on.  Of a changed product the rows of its present content count; those of earlier contents stay until compacted() and serve it if it changes back.
    A product without rows is remembered too.  Rows are added as a batch that counts once it is entered under done, so a run that was cut off leaves nothing behind that is read.
    """
    spark = products.sparkSession
    now = _versions(products, key, version)
    done = _done(spark, path, key)
    fresh = now if done is None else now.join(done.select(key, _MARK).distinct(), [key, _MARK], "left_anti")
    fresh = staged(fresh)
    if done is None or not fresh.isEmpty():
        batch = uuid.uuid4().hex
        rows = make(fresh.drop(_MARK)).join(fresh.select(key, _MARK).distinct(), key)
        rows.withColumn(_BATCH, F.lit(batch)).write.mode("append").parquet(f"{path}/rows")
        fresh.select(key, _MARK).distinct().withColumn(_BATCH, F.lit(batch)).write.mode("append").parquet(f"{path}/done")
    done = spark.read.parquet(f"{path}/done")
    wanted = now.select(key, _MARK).distinct().join(done.groupBy(key, _MARK).agg(F.min(_BATCH).alias(_BATCH)), [key, _MARK])
    return spark.read.parquet(f"{path}/rows").join(wanted, [key, _MARK, _BATCH], "left_semi").drop(_MARK, _BATCH)


def compacted(products: DataFrame, key: str, path: str, to: str, version: str = "") -> None:
    """Writes what cached() would read for the products to a new path; the old one stays as it is."""
    spark = products.sparkSession
    wanted = _versions(products, key, version).select(key, _MARK).distinct()
    done = spark.read.parquet(f"{path}/done").join(wanted, [key, _MARK], "left_semi").groupBy(key, _MARK).agg(F.min(_BATCH).alias(_BATCH))
    spark.read.parquet(f"{path}/rows").join(done, [key, _MARK, _BATCH], "left_semi").write.mode("overwrite").parquet(f"{to}/rows")
    done.write.mode("overwrite").parquet(f"{to}/done")
