"""Hard negatives by a two-dimensional block matrix product.

Rows are cut into blocks along two ways, by label and id, and by chunks of dimensions; anchors are cut likewise.  For a block of rows, a block of anchors
and a chunk of dimensions, a task makes a partial tile of int64 scores; the partial tiles of a pair of blocks are shuffled to one place and added, one after
the other, so a task holds one tile.  Full tiles are reduced where they are added: to each anchor's best rows of its own label first, then, once these
positives are merged, to the best rows of other labels within each positive's window.

A block's range of labels tells which tiles a pass needs: those of equal labels for positives, those of different ones for negatives, so hardly a tile is made twice.
Blocks are dealt by ranges of label and id: a label with a third of all rows fills many blocks, and rare labels share one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, small_batches, written

#: Rows and anchors of a tile, and dimensions of a chunk.
ROWS, ANCHORS, CHUNK = 2048, 64, 32
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 30, 90
#: Sums of products below this are exact in doubles.
_EXACT = 2**53


def quantised(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component, as longs."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * factor).cast("long"))


def sound(vector: Column) -> Column:
    """Whether a vector is there, without a null or non-finite component."""
    v = vector.cast("array<double>")
    return vector.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(name, ids, labels, low, high, dims, chunk, data): blocks of rows (id, label, q) with neighbouring labels, a row for each chunk of their dimensions.

    Within a block ids ascend.  Vectors of different lengths are in different blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out(dims: int) -> pa.RecordBatch:
            block = sorted(held.pop(dims), key=lambda r: r[0])
            labels = [r[1] for r in block]
            data = np.array([r[2] for r in block], dtype="<i8").reshape(len(block), dims).tobytes()
            columns = [pa.array([[r[0] for r in block]], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.int64())), pa.array([min(labels)], pa.int64()), pa.array([max(labels)], pa.int64()), pa.array([dims], pa.int32()), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["ids", "labels", "low", "high", "dims", "data"])

        for b in batches:
            for i, label, q in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                held.setdefault(len(q), []).append((i, label, q))
                if len(held[len(q)]) >= size:
                    yield out(len(q))
        for dims in list(held):
            yield out(dims)

    ranged = rows.repartitionByRange("label", "id").sortWithinPartitions("label", "id")
    return ranged.mapInArrow(run, "ids array<long>, labels array<long>, low long, high long, dims int, data binary").withColumn(name, F.monotonically_increasing_id())


def _chunks(blocks: DataFrame, name: str, ids: str, labels: str, windows: bool = False) -> DataFrame:
    """(name, chunk, low, high, dims, ids, labels, [windows,] data): a row for each chunk of a block's dimensions; ids, labels and windows are with the first chunk only."""
    more = ["windows"] if windows else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                x = np.frombuffer(r["data"], "<i8").reshape(len(r["ids"]), r["dims"])
                for k in range(max(1, -(-r["dims"] // CHUNK))):
                    out = {name: r[name], "chunk": k, "low": r["low"], "high": r["high"], "dims": r["dims"]}
                    out |= {c: r[o] if not k else None for c, o in ((ids, "ids"), (labels, "labels"), *((w, w) for w in more))}
                    out["data"] = np.ascontiguousarray(x[:, k * CHUNK : (k + 1) * CHUNK]).tobytes()
                    yield pa.RecordBatch.from_pylist([out], schema=pa_schema)

    kinds = {name: pa.int64(), "chunk": pa.int32(), "low": pa.int64(), "high": pa.int64(), "dims": pa.int32(), ids: pa.list_(pa.int64()), labels: pa.list_(pa.int64()), **{w: pa.binary() for w in more}, "data": pa.binary()}
    pa_schema = pa.schema(list(kinds.items()))
    spark_kinds = {pa.int64(): "long", pa.int32(): "int", pa.list_(pa.int64()): "array<long>", pa.binary(): "binary"}
    return blocks.select(name, "ids", "labels", "low", "high", "dims", *more, "data").mapInArrow(run, ", ".join(f"{c} {spark_kinds[t]}" for c, t in kinds.items()))


def _product(x: bytes, n: int, y: bytes, m: int) -> np.ndarray:
    """int64 products of the n rows in x with the m rows in y."""
    a, b = np.frombuffer(x, "<i8").reshape(n, -1), np.frombuffer(y, "<i8").reshape(m, -1)
    if a.size and b.size and int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] >= _EXACT:
        return a @ b.T
    return (a.astype("f8") @ b.astype("f8").T).astype("<i8")


def tiles(rows: DataFrame, anchors: DataFrame, wanted: Column, reduce, schema: str) -> DataFrame:
    """What reduce gives of each full tile of scores, for pairs of blocks for which wanted holds.

    rows: (rb, sizes as in _chunks, ids, labels); anchors: (ab, ..., anchor_ids, anchor_labels, windows) with a column rb for each block of rows they meet.
    reduce(tile, anchor_ids, anchor_labels, windows, ids, labels) gives a record batch; the tile has a row for each anchor.
    """
    left = anchors.select("ab", "rb", "chunk", "dims", F.col("low").alias("a_low"), F.col("high").alias("a_high"), "anchor_ids", "anchor_labels", "windows", F.col("data").alias("a_data"))
    pairs = left.join(rows, ["rb", "chunk", "dims"]).where(wanted)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                tile = _product(r["a_data"], r["a_n"], r["data"], r["n"])
                yield pa.RecordBatch.from_arrays([pa.array([r[c]], t) for c, t in kinds.items()] + [pa.array([tile.tobytes()], pa.binary())], [*kinds, "tile"])

    kinds = {"rb": pa.int64(), "ab": pa.int64(), "chunk": pa.int32(), "anchor_ids": pa.list_(pa.int64()), "anchor_labels": pa.list_(pa.int64()), "windows": pa.binary(), "ids": pa.list_(pa.int64()), "labels": pa.list_(pa.int64())}
    width = F.greatest(F.lit(1), F.least(F.lit(CHUNK), F.col("dims") - F.col("chunk") * CHUNK)) * 8
    sized = pairs.select(*kinds, "a_data", "data", (F.length("a_data") / width).cast("int").alias("a_n"), (F.length("data") / width).cast("int").alias("n"))
    made = sized.mapInArrow(partial, "rb long, ab long, chunk int, anchor_ids array<long>, anchor_labels array<long>, windows binary, ids array<long>, labels array<long>, tile binary")
    dealt = made.repartition("rb", "ab").sortWithinPartitions("rb", "ab", "chunk")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, head = None, None, None
        for b in batches:
            for k in range(len(b)):
                key = (b.column(0)[k].as_py(), b.column(1)[k].as_py())
                tile = np.frombuffer(b.column(8)[k].as_buffer(), "<i8")
                if key == now:
                    total += tile
                    continue
                if now is not None:
                    yield reduce(total.reshape(len(head[0]), -1), *head)
                now, total = key, tile.copy()
                head = [np.array(b.column(c)[k].as_py(), dtype=np.int64) if c != 5 else b.column(c)[k].as_py() for c in range(3, 8)]
        if now is not None:
            yield reduce(total.reshape(len(head[0]), -1), *head)

    return dealt.mapInArrow(added, schema)


def _nearest_of_label(count: int):
    """Of each anchor in a tile the best other rows of its label: (anchor_id, id, score)."""

    def reduce(tile: np.ndarray, anchor_ids: np.ndarray, anchor_labels: np.ndarray, _, ids: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
        out: list[tuple] = []
        for scores, anchor, label in zip(tile, anchor_ids, anchor_labels, strict=True):
            at = np.flatnonzero((labels == label) & (ids != anchor))
            if len(at) > count:  # ids ascend, and a stable sort keeps that among equal scores
                at = at[scores[at] >= np.partition(scores[at], len(at) - count)[len(at) - count]]
            at = at[np.argsort(-scores[at], kind="stable")][:count]
            out += [(int(anchor), int(i), int(s)) for i, s in zip(ids[at], scores[at], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], ["anchor_id", "id", "score"])

    return reduce


def _in_windows(count: int, low: int, high: int):
    """Of each anchor and positive in a tile the best rows of other labels in the positive's window: (anchor_id, positive_id, positive_score, id, score)."""

    def reduce(tile: np.ndarray, anchor_ids: np.ndarray, anchor_labels: np.ndarray, windows: bytes, ids: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
        asked: dict[int, list] = {}
        for anchor, positive, score in np.frombuffer(windows, "<i8").reshape(-1, 3).tolist():
            asked.setdefault(anchor, []).append((positive, score))
        out: list[tuple] = []
        for scores, anchor, label in zip(tile, anchor_ids.tolist(), anchor_labels, strict=True):
            if anchor not in asked:
                continue
            at = np.flatnonzero(labels != label)
            at = at[np.argsort(-scores[at], kind="stable")]
            falling = -scores[at]
            for positive, p in asked[anchor]:
                # 100 s <= high p and low p <= 100 s, in whole numbers.
                first = int(np.searchsorted(falling, -(high * p // 100), side="left"))
                for k in at[first : first + count].tolist():
                    if 100 * int(scores[k]) < low * p:
                        break
                    out.append((anchor, positive, p, int(ids[k]), int(scores[k])))
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(5)], ["anchor_id", "positive_id", "positive_score", "id", "score"])

    return reduce


def _windows(pairs: DataFrame) -> DataFrame:
    """(ab, windows): the positives of each block of anchors, as triples of longs (anchor, positive, score); pairs: (ab, anchor_id, positive_id, positive_score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [np.array([[x["anchor_id"], x["positive_id"], x["positive_score"]] for x in xs], dtype="<i8").tobytes() for xs in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], ["ab", "windows"])

    each = pairs.groupBy("ab").agg(F.array_sort(F.collect_list(F.struct("anchor_id", "positive_id", "positive_score"))).alias("p"))
    return each.mapInArrow(run, "ab long, windows binary")


def hard_negatives(df: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of df for which is_anchor holds.

    A score is the whole-number product of two rows' floor(256 * x).  Positives: the best other rows of the anchor's label; negatives: for each of them the best
    rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score; higher scores first, ties by the smaller id.

    Rows with a null id, label or vector, or a null or non-finite component take no part; of rows with equal ids the one with the least label, then values,
    counts.  Vectors of another length don't meet.  An empty table gives no rows; other columns take no part.
    Components so large that sums could pass 63 bits raise an error.
    """
    spark = df.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    whole = df.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).alias("v"), is_anchor.alias("asks"))
    whole = whole.where(F.col("id").isNotNull() & F.col("label").isNotNull() & sound(F.col("v")))
    one = whole.groupBy("id").agg(F.min(F.struct("label", quantised(F.col("v")).alias("q"), F.coalesce("asks", F.lit(False)).alias("asks"))).alias("r"))
    rows = scratch.written(one.select("id", "r.label", "r.q", "r.asks"))
    most = rows.agg(F.max(F.array_max(F.transform("q", F.abs))).alias("x"), F.max(F.size("q")).alias("d")).first()
    if most["x"] is not None and int(most["x"]) ** 2 * most["d"] >= 2**63:
        raise ValueError(f"components up to {most['x'] / 256:g} are too large for whole-number scores of {most['d']} dimensions")
    blocks = scratch.written(packed(rows.select("id", "label", "q"), ROWS, "rb"))
    anchor_blocks = scratch.written(packed(rows.where("asks").select("id", "label", "q"), ANCHORS, "ab"))
    row_chunks = scratch.written(_chunks(blocks, "rb", "ids", "labels"))
    # Blocks of anchors, the stated query set, go to every block of rows: (rb, low, high, dims) of the blocks are joined on dims.
    meta = blocks.select("rb", "dims", F.col("low").alias("r_low"), F.col("high").alias("r_high"))

    def met(asked: DataFrame, wanted: Column) -> DataFrame:
        here = _chunks(asked, "ab", "anchor_ids", "anchor_labels", windows=True)
        return here.join(meta, "dims").where(wanted).drop("r_low", "r_high")

    c = F.col
    overlap = (c("low") <= c("r_high")) & (c("r_low") <= c("high"))
    same = met(anchor_blocks.withColumn("windows", F.lit(b"").cast("binary")), overlap)
    near = tiles(row_chunks, same, F.lit(True), _nearest_of_label(positives), "anchor_id long, id long, score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    found = near.withColumn("n", F.row_number().over(best)).where(c("n") <= positives)
    found = scratch.written(found.select("anchor_id", c("id").alias("positive_id"), c("score").alias("positive_score")))
    of = anchor_blocks.select("ab", F.explode("ids").alias("anchor_id")).distinct()
    asked = scratch.written(anchor_blocks.join(_windows(of.join(found, "anchor_id")), "ab"))
    other = met(asked, ~((c("low") == c("high")) & (c("r_low") == c("r_high")) & (c("low") == c("r_low"))))
    hard = tiles(row_chunks, other, F.lit(True), _in_windows(negatives, low, high), "anchor_id long, positive_id long, positive_score long, id long, score long")
    order = Window.partitionBy("anchor_id", "positive_id", "positive_score").orderBy(F.desc("score"), "id")
    top = hard.withColumn("rank", F.row_number().over(order)).where(c("rank") <= negatives)
    out = written(top.select("anchor_id", "positive_id", "rank", c("id").alias("negative_id"), "positive_score", c("score").alias("negative_score")))
    scratch.drop()
    return out
