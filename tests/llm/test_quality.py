import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import quality

from .conftest import DOCS, words


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(400):
        good = i % 5 != 0
        w = words(rng, 50)
        text = " ".join(w) if good else " ".join(f"{x}***" if i % 2 else f"{x.upper()}!!" for x in w)
        docs.append((i, text, None, None, None, 1, 1, "k", 1, 0.5))
        if i % 3:
            labels.append((i, int(good), 0))
    docs += [(None, "null id", None, None, None, 1, 1, "k", 1, 0.5), (900, None, None, None, None, 1, 1, "k", 1, 0.5), (901, "", None, None, None, 1, 1, "k", 1, 0.5), docs[3]]
    labels += [(None, 1, 0), (7, None, 0), labels[0]]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(made):
    docs, labels = made
    teaches = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 != 2
    got = quality.score_quality(docs, labels, teaches).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [(r.predicted, int(r.doc_id % 5 != 0)) for r in got if not r.teaches and r.doc_id is not None and r.doc_id < 900]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.97
    blank = {r.doc_id: r.score for r in got if r.doc_id in (900, 901)}
    assert blank[900] == blank[901]


def test_nothing_to_learn_from(spark, made, no_docs):
    docs, labels = made
    none = labels.limit(0)
    assert {r.score for r in quality.score_quality(docs, none, F.lit(True)).collect()} == {0.5}
    assert quality.score_quality(no_docs, labels, F.lit(True)).collect() == []


def test_risk_is_not_negative():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, quality.DIM))
    pos = x[:, 0] > 0
    for scale in (0.0, 1.0, 20.0):
        w = np.zeros(quality.DIM)
        w[0] = scale
        f = np.clip(x @ w, -30, 30)
        s = 1 / (1 + np.exp(-f))
        sums = {k: np.zeros(n) for k, n in quality._SIZES.items()}
        sums["n_p"][0], sums["n_u"][0] = pos.sum(), len(x)
        sums["loss_p"][0], sums["loss_n"][0], sums["loss_u"][0] = -np.log(s[pos]).sum(), -np.log(1 - s[pos]).sum(), -np.log(1 - s).sum()
        assert quality.risk(sums, 0.9)[0] >= 0
