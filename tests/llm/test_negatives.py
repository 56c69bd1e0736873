import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import negatives as M
from pairloom.llm.queries import op13_hard_negatives

from ..conftest import DATA

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank int, ids int"


def brute(rows, every):
    """The contract, row by row; rows: (id, vector, label)."""
    sound = {(i, int(lab), tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, lab in rows if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)}
    sound = {min(r for r in sound if r[0] == i) for i in {r[0] for r in sound}}
    out = set()
    for a, lab, q in sound:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p, strict=True)), i, other) for i, other, p in sound if len(p) == len(q))
        for s, i in [(-s, i) for s, i, other in scored if other == lab and i != a][:5]:
            kept = [(i, -n, j) for n, j, other in scored if other != lab and 30 * s <= 100 * -n <= 90 * s][:10]
            out |= {(a, i, r, j, s, n) for r, (_, n, j) in enumerate(kept, 1)}
    return sorted(out)


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    rows = [(i, v, (lab + 1) % 10 if i % 7 == 0 and lab is not None else lab) for i, v, lab in rows]
    got = op13_hard_negatives(spark, str(DATA))
    assert got.columns[:6] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 100)


@pytest.mark.parametrize("blocks", [(M.ROWS, M.ANCHORS, M.CHUNK), (7, 3, 2)])
def test_odd_rows_and_small_blocks(spark, monkeypatch, blocks):
    for name, v in zip(("ROWS", "ANCHORS", "CHUNK"), blocks, strict=True):
        monkeypatch.setattr(M, name, v)
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.25, 0.5, 0.75, 1.0]) for _ in range(5)], rng.choice([1, 1, 1, 2, 3])) for i in range(90)]
    rows += [rows[3], rows[8], (8, rows[9][1], 2), (90, rows[8][1], 1), (91, rows[8][1], 2)]  # repeated rows, an id twice, ties
    rows += [(92, None, 1), (93, [1.0, None, 1.0, 1.0, 1.0], 1), (94, [float("nan")] * 5, 1), (95, [float("inf")] * 5, 2), (96, [1.0] * 5, None), (None, [1.0] * 5, 1), (97, [], 1), (98, [], 2), (99, [0.5, 0.5], 1)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)
    got = M.hard_negatives(df, F.col("vec_id") % 4 == 0, F.col("label"))
    assert sorted(map(tuple, got.collect())) == brute(rows, 4)
    assert M.hard_negatives(df.limit(0), F.lit(True), F.col("label")).collect() == []


def test_large_components(spark):
    df = spark.createDataFrame([(1, [2.0**22, 1.0], 1), (2, [2.0**22, 3.0], 1), (3, [2.0**21, 5.0], 2)], "vec_id long, embedding array<double>, label int")
    got = M.hard_negatives(df, F.col("vec_id") == 1, F.col("label"))
    assert [tuple(r) for r in got.collect()] == [(1, 2, 1, 3, 2**60 + 3 * 2**16, 2**59 + 5 * 2**16)]
    with pytest.raises(ValueError, match="too large"):
        M.hard_negatives(df.withColumn("embedding", F.array(F.lit(1e15))), F.lit(True), F.col("label"))
