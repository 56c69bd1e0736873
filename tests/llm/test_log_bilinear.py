import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.llm import log_bilinear as B
from pairloom.llm.common import crc_mod


@pytest.mark.parametrize("frequent", [200_000, 30])
def test_base_score_equals_brute_force(docs, rows, frequent):
    teaches = F.coalesce(F.col("doc_id") % 3 != 2, F.lit(False))
    got = B.score_texts(docs, teaches, words=16, buckets=8, frequent=frequent).collect()
    assert len(got) == len(rows)
    count = Counter(t for r in rows if r[0] is not None and r[0] % 3 != 2 for t in B.tokens_of(r[1]))
    total, distinct = sum(count.values()), len(count)
    want = []
    for r in rows:
        tokens = B.tokens_of(r[1])
        want.append((str(r[0]), len(tokens), sum(count[t] > 0 for t in tokens), total, round(sum(math.log10((count[t] + 1) / (total + distinct + 1)) for t in tokens), 4)))
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == sorted(want)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_score_equals_brute_force(spark):
    texts = ["ab cd ef ab", "ab cd", None, "ef xyz ab cd cd", "gh xyz gh"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = B.token_counts(rows, "text")
    total, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    model = B.fit(rows.select(F.xxhash64("doc_id", "text").alias("h"), "text"), counts, total, distinct, 3, 4, 100)
    r, q, k, c, b, bk = (x.astype("f8") for x in model["params"])
    size, n, count = B.class_size(len(r)), len(r), Counter(t for x in texts for t in B.tokens_of(x))
    table = {t: int(e) for t, e in zip(model["tokens"], model["entries"], strict=True) if e >= 0}
    assert len(table) == 4 and n == 1 + 4 + 3
    rest = [t for t in count if t not in table]

    def entry(t):
        return table.get(t, model["buckets"][B.bucket_of(t, 4)])

    def prob(w, before):
        h = sum(c[i] * r[e] for i, e in enumerate(before))
        classes = np.exp(bk + k @ h)
        inside = np.exp(b + q @ h)
        low = w // size * size
        return classes[w // size] / classes.sum() * inside[w] / inside[low : low + size].sum()

    got = {x.doc_id: x.score for x in B.score_texts(rows, F.lit(True), words=3, buckets=4, frequent=100).collect()}
    few = {x.doc_id: x.score for x in B.score_texts(rows.repartition(3), F.lit(True), words=3, buckets=4, frequent=4).collect()}
    for d, text in enumerate(texts):
        before, score = [model["end"]] * B.CONTEXT, 0.0
        for t in B.tokens_of(text):
            score += math.log10(prob(entry(t), before))
            if t not in table:
                same = [x for x in rest if B.bucket_of(x, 4) == B.bucket_of(t, 4)]
                score += math.log10((count[t] + 1) / (sum(count[x] for x in same) + len(same) + 1))
            before = [entry(t), *before[:-1]]
        assert got[d] == pytest.approx(score, abs=1e-3) and few[d] == pytest.approx(score, abs=1e-3)


def test_probabilities_sum_to_one():
    params = B.first_params(-np.sort(-np.random.default_rng(0).dirichlet(np.ones(23))))
    for scale in (1, 300):  # with and without danger of overflow
        p = [x * np.float32(scale) for x in params[:2]] + params[2:]
        got = [B.log_probs(p, np.array([7, 20, 1, 3, w], dtype=np.int32), np.array([4]))[0] for w in range(23)]
        assert np.exp(got).sum() == pytest.approx(1, abs=1e-4)


def test_training_learns_structure():
    rng = np.random.default_rng(1)
    k = 12
    seq = [0]
    for _ in range(40_000):
        seq.append((seq[-1] * 5 + 1) % k if rng.random() < 0.8 else int(rng.integers(k)))
    seq = np.array(seq)
    share = (np.bincount(seq, minlength=k) + 1.0) / (len(seq) + k)
    texts = [x.astype(np.int32) for x in np.split(seq[:40_000], 40)]
    trainer = B.Trainer(B.first_params(share), share, 3)
    trainer.learn(texts, 0, 6)
    before = B.log_probs(B.first_params(share), *B.sequence(texts[:3], 0)).sum()
    assert B.log_probs(trainer.p, *B.sequence(texts[:3], 0)).sum() > 0.7 * before


def test_held_out_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = B.score_texts(docs, crc_mod("doc_id", 7) != 2).where(crc_mod("doc_id", 7) == 2).agg(F.sum("n_tokens"), F.sum("score") - F.sum("base_score")).first()
    assert got[1] / got[0] > 0.3, got


@pytest.mark.parametrize("shard", [B.WARM, 20_000])
def test_partitions_do_not_matter(spark, monkeypatch, shard):
    monkeypatch.setattr(B, "SHARD", shard)
    monkeypatch.setattr(B, "WARM", shard)
    monkeypatch.setattr(B, "FAN", 2)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, many = ({r.doc_id: r for r in B.score_texts(docs.repartition(n), crc_mod("doc_id", 7) != 2).collect()} for n in (1, 16))
    assert all(many[d].score == pytest.approx(r.score, abs=1e-3 + 1e-6 * r.n_tokens) for d, r in one.items())
    assert sum(r.score - r.base_score for r in one.values()) > 0


def test_frequent_tokens_of_one_level(spark):
    counts = spark.createDataFrame([(f"w{i}".encode(), 5) for i in range(2000)] + [(b"top", 9)], "token binary, c long")
    got = B.frequent_tokens(counts, 1000)
    assert got[0] == (b"top", 9) and 900 < len(got) < 1100
    assert got == B.frequent_tokens(counts.repartition(7), 1000)
    assert B.frequent_tokens(counts.where("c > 9"), 1000) == []


def test_bucket_in_sql_is_the_same(spark):
    tokens = [b"a", b"ab", b"abc", b"abcdef", "né".encode(), b"\xff\xfe"]
    rows = spark.createDataFrame([(t,) for t in tokens], "token binary").select("token", (F.crc32(F.substring("token", -B.TAIL, B.TAIL)) % 64).alias("k")).collect()
    assert all(r.k == B.bucket_of(bytes(r.token), 64) for r in rows)


def test_nothing_to_learn_from_and_empty(docs, rows, no_docs):
    got = B.score_texts(docs, F.lit(False)).collect()
    assert len(got) == len(rows) and all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in got)
    assert B.score_texts(no_docs, F.lit(True)).collect() == []


def test_model_grows_with_the_corpus():
    sizes = [B.words_for(n) for n in (0, 10**3, 10**6, 10**9, 10**12)]
    assert sizes[0] == 0 and all(y > x for x, y in zip(sizes, sizes[1:], strict=False)) and sizes[-1] > 40_000
