"""Catalog readers and writers."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

COMMON = (
    "item_id name brand_raw name_clean description category department url item_info tags subcategory sizing_comp size_raw "
    "datapoint_id raw_data_id created_at_utc updated_at_utc"
).split()
COLUMNS_A = [*COMMON, "item_type", "is_private_label"]
COLUMNS_B = [*COMMON, "is_organic"]
#: What linking reads; all else is ignored.
USED = ["item_id", "name", "brand_raw", "description", "item_info", "sizing_comp", "tags"]


def schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, every column text; quoted line breaks and doubled quotes are allowed, a byte-order mark goes."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def positioned(df: DataFrame) -> DataFrame:
    """A table just read from files, with position: file, start of the block and place in it, which order its rows as they stand there (files by name)."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return df.select("*", place.alias("position"))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(item_id_A, item_id_B, position) of a CSV with pairs: the columns of these names, else the first and the second."""
    df = positioned(spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False))
    names = {c.lstrip("\ufeff"): c for c in df.columns[:-1]}
    if len(names) < 2:
        raise ValueError(f"{path} has no two columns")
    pick = [names.get(n, df.columns[k]) for k, n in enumerate(("item_id_A", "item_id_B"))]
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(pick, ("item_id_A", "item_id_B"), strict=True)], "position")


def catalog(df: DataFrame) -> DataFrame:
    """The used columns of a catalog as text; a missing one is empty."""
    return df.select(*[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in USED])


def keyed(df: DataFrame, key: str, *order: str) -> DataFrame:
    """df with a dense number from 0 in the given order.

    Ranges are sorted and written apart, so no task sees all rows and a lost executor changes no number: partition sizes are summed on the driver, one for each partition.
    """
    from ..plans.stages import staged

    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    ranged = staged(ranged)
    sizes = sorted(ranged.groupBy("__part").agg(F.count("*").alias("n"), F.min("__at").alias("low")).collect())
    starts, total = [], 0
    for r in sizes:
        starts.append((r["__part"], r["low"], total))
        total += r["n"]
    offset = spark.createDataFrame(starts, "__part int, __low long, __start long")
    out = ranged.join(F.broadcast(offset), "__part").withColumn(key, F.col("__at") - F.col("__low") + F.col("__start"))
    return out.drop("__part", "__at", "__low", "__start")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table, dealt over as many tasks as the session asks for: its rows are few bytes but much work, and a file of a few MB would be one task."""
    return spark.read.parquet(f"{sf_dir}/part.parquet").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")


def part_catalogs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The part table as two catalogs: even keys against odd keys, keyed row_key and b_index by half the part key."""
    part = parts(spark, sf_dir)
    row = part.select(
        "p_partkey", F.col("p_partkey").cast("string").alias("item_id"), F.concat_ws(" ", "p_name", "p_type", F.col("p_size").cast("string"), F.lit("oz")).alias("name"),
        F.col("p_brand").alias("brand_raw"), F.lit("").alias("description"), F.lit("").alias("item_info"),
        F.to_json(F.struct(F.concat(F.col("p_size").cast("string"), F.lit(" oz")).alias("size_user_friendly"))).alias("sizing_comp"), F.lit("").alias("tags"),
    )
    half = F.floor(F.col("p_partkey") / 2)
    a = row.where("p_partkey % 2 = 0").withColumn("row_key", half).drop("p_partkey")
    b = row.where("p_partkey % 2 = 1").withColumn("b_index", half).drop("p_partkey")
    return a, b


def write_version(tables: dict[str, Callable[[str], DataFrame]], spark: SparkSession, path: str) -> str:
    """Writes CSV tables under a new folder of path and then points to it in one step, so a reader finds either all of them or those before; the folder.

    tables: by name, each made from the folder, in order, so a later one can read an earlier one.  A run that fails leaves the pointer as it was.
    """
    from .config import write_text

    folder = f"{path.rstrip('/')}/versions/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    for name, make in tables.items():
        make(folder).write.csv(f"{folder}/{name}", header=True)
    write_text(spark, f"{path.rstrip('/')}/CURRENT", folder.rsplit("/", 1)[1])
    return folder


def current(spark: SparkSession, path: str) -> str:
    """The folder of the tables that were written last."""
    return f"{path.rstrip('/')}/versions/{spark.read.text(f'{path.rstrip("/")}/CURRENT').first()[0]}"


def write_verdicts(verdicts: DataFrame, path: str) -> str:
    """Three CSV outputs, as one version: all verdicts, matched pairs, rows for review.  The verdicts are written once and read for the other two; lists are JSON texts."""
    spark = verdicts.sparkSession
    plain = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name) for f in verdicts.schema]
    verdicts = verdicts.select(*plain)
    done = lambda folder: spark.read.csv(f"{folder}/all_verdicts", header=True, schema=verdicts.schema)
    tables = {
        "all_verdicts": lambda folder: verdicts,
        "submission_matches": lambda folder: done(folder).where("final_verdict = 'MATCH'").select("item_id_A", F.col("selected_item_id_B").alias("item_id_B")),
        "manual_review": lambda folder: done(folder).where("final_verdict = 'REVIEW'"),
    }
    return write_version(tables, spark, path)
