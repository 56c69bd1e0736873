"""Text quality from positive and unlabelled rows.

The classifier is linear over shape features of a whole text: frequencies of byte classes and of pairs of them, and a few ratios.
It minimises the non-negative unbiased risk with the logistic loss l,

    prior * E_pos[l(f)] + max(0, E_unl[l(-f)] - prior * E_pos[l(-f)]),

over trusted positives, all unlabelled text and an estimated class prior.  With this loss the part inside the maximum, added
to the first term, is convex, so Newton steps solve it; where the maximum is zero only the first term counts.  Each step is one pass
over a table of features that sums gradient and curvature per task; sizes sent to the driver don't grow with the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

STEPS = 12
RIDGE = 1e-3
#: A text this likely to be good is predicted so.
THRESHOLD = 0.7
#: Byte classes, by what sets junk apart from prose.
_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,;:'\"", "!?", "|", "#*$%&@^~_=+<>\\/")
OTHER, HIGH = len(_CLASSES), len(_CLASSES) + 1
N = len(_CLASSES) + 2
RATIOS = 7
DIM = N + N * N + RATIOS + 1


def _table() -> np.ndarray:
    out = np.full(256, OTHER, dtype=np.uint8)
    out[128:] = HIGH
    for k, chars in enumerate(_CLASSES):
        out[list(chars.encode())] = k
    return out


_TABLE = _table()


def features(text: str | None) -> np.ndarray:
    """DIM values from 0 to 1; an empty text has only the constant."""
    data = (text or "").encode("utf-8", "replace")
    x = np.zeros(DIM, dtype="f4")
    x[-1] = 1
    if not data:
        return x
    kind = _TABLE[np.frombuffer(data, dtype=np.uint8)]
    x[:N] = np.sqrt(np.bincount(kind, minlength=N) / len(kind))
    if len(kind) > 1:
        x[N : N + N * N] = np.sqrt(np.bincount(kind[:-1].astype(np.int16) * N + kind[1:], minlength=N * N) / (len(kind) - 1))
    words, lines = data.split(), [line for line in data.split(b"\n") if line.strip()]
    if words:
        x[N + N * N : -1] = (
            len(set(words)) / len(words),
            len(set(lines)) / len(lines),
            min(1.0, len(data) / len(words) / 20),
            min(1.0, np.log1p(len(words)) / 10),
            min(1.0, np.log1p(len(words) / len(lines)) / 6),
            sum(len(w) <= 3 for w in words) / len(words),
            sum(map(bytes.__eq__, words[1:], words)) / len(words),
        )
    return x


def feature_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [features(t).astype("<f4").tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.binary())], ["id", "x"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, x binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f4").reshape(-1, DIM).astype("f8")


_SIZES = {"n_p": 1, "n_u": 1, "loss_p": 1, "loss_n": 1, "loss_u": 1, "x_p": DIM, "grad_p": DIM, "grad_u": DIM, "hess_p": DIM * DIM, "hess_u": DIM * DIM}


def _sums(rows: DataFrame, w: np.ndarray) -> dict[str, np.ndarray]:
    """Sums over positives (p) and unlabelled rows (u) at w; rows: (x, positive)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = {k: np.zeros(n) for k, n in _SIZES.items()}
        for b in batches:
            x, pos = _matrix(b.column(0)), b.column(1).to_numpy(zero_copy_only=False)
            f = np.clip(x @ w, -30, 30)
            s = 1 / (1 + np.exp(-f))
            xp, sp = x[pos], s[pos]
            new = (len(xp), len(x), -np.log(sp).sum(), -np.log(1 - sp).sum(), -np.log(1 - s).sum(), xp.sum(axis=0), (sp - 1) @ xp, s @ x, (xp.T * (sp * (1 - sp))) @ xp, (x.T * (s * (1 - s))) @ x)
            for k, v in zip(_SIZES, new, strict=True):
                acc[k] += np.ravel(v)
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(list(acc.values())).tobytes()], pa.binary())], ["sums"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros(sum(_SIZES.values()))
        for b in batches:
            for x in b.column(0).to_pylist():
                acc += np.frombuffer(x)
        yield pa.RecordBatch.from_arrays([pa.array([acc.tobytes()], pa.binary())], ["sums"])

    # As many tasks add up as partitions go to each of them.
    fan = math.isqrt(rows.rdd.getNumPartitions()) + 1
    got = rows.select("x", "positive").mapInArrow(run, "sums binary").repartition(fan).mapInArrow(total, "sums binary").collect()
    flat = sum((np.frombuffer(r[0]) for r in got), np.zeros(sum(_SIZES.values())))
    return dict(zip(_SIZES, np.split(flat, np.cumsum(list(_SIZES.values()))[:-1]), strict=True))


def risk(s: dict[str, np.ndarray], prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Non-negative risk, gradient and curvature from the sums."""
    n_p, n_u = max(1.0, s["n_p"][0]), max(1.0, s["n_u"][0])
    first = prior * s["loss_p"][0] / n_p
    second = s["loss_u"][0] / n_u - prior * s["loss_n"][0] / n_p
    square = (DIM, DIM)
    if second < 0:
        return first, prior * s["grad_p"] / n_p, prior * s["hess_p"].reshape(square) / n_p
    return first + second, s["grad_u"] / n_u - prior * s["x_p"] / n_p, s["hess_u"].reshape(square) / n_u


def fit(rows: DataFrame, prior: float, steps: int = STEPS) -> np.ndarray:
    """Weights of the least risk.  rows: (x, positive), every row unlabelled text and some of them trusted positives.

    Without positives, or with a prior of 0 or 1, the weights are a constant: the prior's log-odds.
    """
    w = np.zeros(DIM)
    edge = min(max(prior, 1e-3), 1 - 1e-3)
    w[-1] = np.log(edge / (1 - edge))
    if edge != prior:
        return w
    best, best_w, step = np.inf, w.copy(), np.zeros(DIM)
    for _ in range(steps):
        s = _sums(rows, w)
        if not s["n_p"][0]:
            return w
        value, gradient, curve = risk(s, prior)
        value += RIDGE / 2 * w[:-1] @ w[:-1]
        if value > best + 1e-9:
            step /= 4
            w = best_w + step
            if np.abs(step).max() < 1e-4:
                break
            continue
        gained, best, best_w = best - value, value, w.copy()
        if gained < 1e-6:
            break
        ridge = np.full(DIM, RIDGE)
        ridge[-1] = 1e-9
        step = -np.linalg.solve(curve + np.diag(ridge) + 1e-9 * np.eye(DIM), gradient + ridge * w)
        w = best_w + step
    return best_w


def score_quality(df: DataFrame, labels: DataFrame, teaches, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, teaches, score, predicted) for each row of df.

    teaches: rows whose label and text may be learned from.  A document is a trusted positive if it teaches and all its labels are 1.  The prior is the share of
    positives among taught labels.  Null and empty texts get the constant's score; null ids have no label; null labels count as none.
    """
    small_batches(df.sparkSession)
    good = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("lid")).agg(F.min(label_col).alias("label"))
    x = feature_rows(df.select(id_col, text_col), id_col, text_col)
    rows = x.join(good, x["id"] == good["lid"], "left").withColumnRenamed("id", id_col)
    rows = written(rows.select(id_col, "x", teaches.alias("teaches"), "label"))
    taught = rows.where("teaches").select("x", F.coalesce(F.col("label") == 1, F.lit(False)).alias("positive"), "label")
    prior = taught.where("label is not null").agg(F.avg(F.col("positive").cast("double"))).first()[0]
    w = fit(taught, 0.5 if prior is None else float(prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = 1 / (1 + np.exp(-np.clip(_matrix(b.column(2)) @ w, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score)], ["id", "teaches", "score"])

    kind = df.schema[id_col].dataType.simpleString()
    got = rows.select(F.col(id_col).alias("id"), "teaches", "x").mapInArrow(run, f"id {kind}, teaches boolean, score double")
    return got.select(F.col("id").alias("doc_id"), "teaches", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
