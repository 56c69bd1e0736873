"""Rows of the source catalog that arrive over time.

Every micro-batch is worked on by a batch function and its rows are written to a folder of the batch's number, which a replay of the batch overwrites: with the
stream's checkpoint each row is worked on exactly once as far as a reader can see.  What depends on one row only is done as it arrives; checks that compare the matches of
one target are a batch job over all that has arrived.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import link
from ..plans.stages import exists

BATCH = "arrival"


def arrive(stream: DataFrame, work: Callable[[DataFrame], DataFrame], path: str, once: bool = True, every: str | None = None) -> StreamingQuery:
    """Starts a query that keeps work(rows) of each micro-batch under path; once: until what is there now is read, else every so often (as in "1 minute") until it is stopped.

    The checkpoint lies under the same path: a query started again there goes on after the last batch that was finished.
    """

    def keep(rows: DataFrame, number: int) -> None:
        work(rows).write.mode("overwrite").parquet(f"{path}/rows/{BATCH}={number}")

    writer = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{path}/checkpoint")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every or "0 seconds")).start()


def arrived(spark: SparkSession, path: str, key: str = "row_key") -> DataFrame:
    """The rows kept under path; of a key that came in several batches those of the last."""
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    last = rows.groupBy(key).agg(F.max(BATCH).alias(BATCH))
    return rows.join(last, [key, BATCH], "left_semi").drop(BATCH)


def link_arrivals(stream: DataFrame, b: DataFrame, path: str, settings: link.Settings | None = None, once: bool = True, every: str | None = None) -> StreamingQuery:
    """Starts the linkage of a stream of source rows (row_key and the catalog columns) with a catalog; settled() reads what came of it."""
    s = settings or link.Settings()
    return arrive(stream, lambda rows: link.provisional(rows, b, s), path, once, every)


def settled(spark: SparkSession, b: DataFrame, path: str) -> DataFrame:
    """One verdict for each row that has arrived, as link() gives for all of them at once: checks over the matches of a target see all batches."""
    if not exists(spark, f"{path}/rows"):
        raise ValueError(f"nothing has arrived under {path}")
    return link.checked(arrived(spark, path), b)
