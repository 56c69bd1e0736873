"""Phrases by hash lookup against a plain search."""

import random

from pyspark.sql import functions as F

from pairloom.functions import lexicon as L


def plain(text, lexicon):
    return [(a, L.CANON.get(p, p)) for a, p in lexicon if L._plain(p) and f" {L._plain(p)} " in text]


def test_equals_a_plain_search(spark):
    rng = random.Random(2)
    words = ["milk", "dark", "chocolate", "free", "fat", "2", "k", "cup", "a", "aa", "of", "strawberries"]
    texts = ["  ", " ", *(f" {' '.join(rng.choice(words) for _ in range(rng.randint(1, 30)))} " for _ in range(80))]
    lexicon = [*L.pairs(L.DEFAULT | L.WHOLE_TEXT), ("x", "a of a"), ("x", "a"), ("y", "a"), ("y", "%"), ("flavor", "dark chocolate")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: [(h.attr, h.term) for h in r.h] for r in df.select("i", L.hits(F.col("t"), lexicon).alias("h")).collect()}
    assert got == {i: plain(t, lexicon) for i, t in enumerate(texts)} and any(got.values())
    assert df.select(L.hits(F.col("t"), []).alias("h")).distinct().collect() == [(None,)] or df.select(F.size(L.hits(F.col("t"), [])).alias("n")).distinct().first().n == 0


def test_a_long_lexicon_finds_the_same(spark):
    many = [("made", f"w{i} v{i % 7} u{i}") for i in range(3000)]
    df = spark.createDataFrame([(" x w5 v5 u5 w2999 v3 u2999 w1 v1 u2 ",)], "t string")
    assert [h.term for h in df.select(L.hits(F.col("t"), many).alias("h")).first().h] == ["w5 v5 u5", "w2999 v3 u2999"]
