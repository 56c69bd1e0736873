"""Nearest neighbours by cosine with a block matrix join.

Equal vectors form one class, which keeps only its k + 1 smallest ids: no search needs more of them.  Classes are packed
into blocks of at most ``BLOCK`` unit vectors, quantised to int8 with each vector's scale and quantisation error.
Blocks of queries are broadcast in chunks of bounded size to where the candidates are.  A tile is a block of queries times a block of candidates: one matrix product of the int8 values (exact for any number of
components), and bounds on the cosine from the errors.  Only pairs whose upper bound reaches the k-th best lower bound are recomputed, in
double precision from the original vectors.  Heaps merge the tiles of a task, and a last ranking merges the tasks.

The result is exact: what the bounds drop can't be among the k nearest.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

BLOCK = 4096
QUERY_BLOCK = 1024
K = 5
#: Bytes of query vectors that are broadcast at once; the blocks of candidates are read again for each such chunk.
CHUNK_BYTES = 64_000_000
#: Vectors whose largest component lies outside are scaled first, as their squares could vanish or overflow.
SMALL, LARGE = 1e-100, 1e100
#: Components whose int8 products are summed in float32, which is exact up to 1,040 of them; sums of slabs are added in doubles.
SLAB = 1024
#: Above the rounding errors of the scalings.
SLACK = 1e-5


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scale, norm of the scaled values and norm of the error, of the rows of x as unit vectors."""
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.sqrt((back * back).sum(axis=1)), np.sqrt(((unit - back) ** 2).sum(axis=1))


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the rows of a and b in double precision; equal rows give equal results wherever they stand."""
    return (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def packed(vectors: DataFrame, size: int, name: str) -> DataFrame:
    """(name, ids, dims, data): blocks of so many classes; a partition's vectors of one length are packed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dims: int) -> pa.RecordBatch:
            rows = held.pop(dims)
            data = np.array([v for _, v in rows], dtype="<f8").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([[i for i, _ in rows]], pa.list_(pa.list_(pa.int64()))), pa.array([dims], pa.int32()), pa.array([data], pa.binary())], ["ids", "dims", "data"])

        for b in batches:
            for ids, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.setdefault(len(v), []).append((ids, v))
                if len(held[len(v)]) >= size:
                    yield out(len(v))
        for dims in list(held):
            yield out(dims)

    return vectors.mapInArrow(run, "ids array<array<long>>, dims int, data binary").withColumn(name, F.monotonically_increasing_id())


def _tile(query_ids: list, q: np.ndarray, ids: list, x: np.ndarray, best: dict, k: int) -> None:
    """Adds the nearest candidates of one block to best: heaps by query class, worst first."""
    qq, qs, qn, qe = quantised(q)
    xq, xs, xn, xe = quantised(x)
    sums = np.zeros((len(q), len(x)))
    for at in range(0, q.shape[1], SLAB):
        sums += qq[:, at : at + SLAB].astype("f4") @ xq[:, at : at + SLAB].astype("f4").T
    about = sums * qs[:, None] * xs
    error = qn[:, None] * xe + qe[:, None] * (xn + xe) + SLACK
    low = about - error
    # A class may be the query itself, so one more class than k must be kept; its other ids come along.
    keep = min(k + 1, low.shape[1])
    bound = np.partition(low, low.shape[1] - keep, axis=1)[:, low.shape[1] - keep]
    for i, first in enumerate(query_ids):
        heap = best.setdefault(first[0], [])
        floor = max(bound[i], heap[0][0] - SLACK) if len(heap) > k else bound[i]
        near = np.flatnonzero(about[i] + error[i] >= floor)
        for s, j in zip(exact(np.broadcast_to(q[i], (len(near), q.shape[1])), x[near]).tolist(), near.tolist(), strict=True):
            for v in ids[j]:
                if len(heap) <= k:
                    heapq.heappush(heap, (s, -v))
                elif (s, -v) > heap[0]:
                    heapq.heapreplace(heap, (s, -v))


def search(df: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows of every row for which is_query holds.

    Cosine in double precision, nearest first, ties to the smaller id.  Vectors that are null or zero, or hold null or non-finite
    components, and rows with a null id, take no part; vectors of another length than the query's are no candidates.
    Rows with equal ids and vectors count once; other columns take no part.
    """
    small_batches(df.sparkSession)
    v = F.col(vector_col).cast("array<double>")
    sound = F.size(v) > 0
    sound &= ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("v"), is_query.alias("asks")).where(sound)
    largest = F.array_max(F.transform("v", F.abs))
    rows = rows.withColumn("most", largest).withColumn("v", F.when(F.col("most").between(SMALL, LARGE), F.col("v")).otherwise(F.transform("v", lambda x: x / F.col("most")))).drop("most")
    rows = written(rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).withColumn("h", F.xxhash64("v")))
    place = F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))
    kept = rows.select("h", "v", "id").distinct().withColumn("n", place).where(F.col("n") <= k + 1)
    classes = kept.groupBy("h", "v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = written(classes.repartition(F.col("ids")[0]))
    asked = rows.where("asks").select("h", "v").distinct().join(classes, ["h", "v"]).select("ids", "v")
    asks = written(packed(asked.repartition(max(1, -(-asked.count() // QUERY_BLOCK))), QUERY_BLOCK, "qb"))
    blocks = written(packed(classes.select("ids", "v"), BLOCK, "cb"))

    def nearest_of(chunk: list[int]) -> DataFrame:
        held = df.sparkSession.sparkContext.broadcast([(r["dims"], r["ids"], bytes(r["data"])) for r in asks.where(F.col("qb").isin(chunk)).collect()])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: dict = {}
            queries = [(dims, ids, np.frombuffer(data, "<f8").reshape(-1, dims)) for dims, ids, data in held.value]
            for b in batches:
                for ids, dims, data in zip(*(b.column(i) for i in range(3)), strict=True):
                    x, ids = np.frombuffer(data.as_buffer(), "<f8").reshape(-1, dims.as_py()), ids.as_py()
                    for q_dims, q_ids, q in queries:
                        if q_dims == x.shape[1]:
                            _tile(q_ids, q, ids, x, best, k)
            out = [(q, -v, s) for q, heap in best.items() for s, v in heap]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.float64())], ["q", "id", "score"])

        return blocks.select("ids", "dims", "data").mapInArrow(run, "q long, id long, score double")

    chunks: list[list[int]] = [[]]
    size = 0
    for r in asks.select("qb", F.length("data").alias("bytes")).orderBy("qb").collect():
        if chunks[-1] and size + r["bytes"] > CHUNK_BYTES:
            chunks.append([])
            size = 0
        chunks[-1].append(r["qb"])
        size += r["bytes"]
    near = nearest_of(chunks[0]) if len(chunks) == 1 else functools.reduce(DataFrame.union, [written(nearest_of(c)) for c in chunks])
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    near = near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n")
    own = classes.select("h", "v", F.col("ids")[0].alias("q"))
    asking = rows.where("asks").select("id", "h", "v").distinct().join(own, ["h", "v"]).select(F.col("id").alias("query_id"), "q")
    found = asking.join(near, "q").where("query_id <> id")
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")))
    return found.where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
