"""Bounded retrieval against all pairs that the channels join."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pairloom.functions import text as T
from pairloom.operators import blocking as B
from pairloom.operators import index, topk
from pairloom.plans.stages import Folder, staged

COLUMNS = "item_id string, name string, brand_raw string, description string, item_info string, sizing_comp string, tags string"


def catalogs(spark, seed, n=120):
    """Titles over a small vocabulary with numbers, brands of all kinds, equal and empty titles."""
    rng = random.Random(seed)
    words = [f"w{'abcdefghijklmnop'[min(int(rng.expovariate(0.25)), 15)]}x" for _ in range(40)]
    private = [sorted(T.LABELS_A)[0], sorted(T.LABELS_B)[0], "acme", "acme", "zen", "rare", ""]

    def row(i, key):
        title = " ".join([*rng.sample(words, rng.randint(0, 5)), *(f"{rng.randint(1, 6)} oz" for _ in range(rng.choice([0, 1, 1, 2, 7])))])
        return (i, f"{key}{i}", title, rng.choice(private), "", "", "", "")

    a, b = ([row(i, k) for i in range(n)] for k in "ab")
    a[3] = (3, "a3", *b[5][2:])
    b[6] = (6, "b6", *b[5][2:])
    return spark.createDataFrame(a, f"row_key long, {COLUMNS}"), spark.createDataFrame(b, f"b_index long, {COLUMNS}")


def counted(a, b):
    fa, fb = B.prepared(a, b, False)
    n = fb.where("brand <> ''").groupBy("brand").agg(F.count("*").alias("n_brand"))
    return fa.join(n, "brand", "left"), fb


@pytest.mark.parametrize("seed,pool,large", [(1, 3, 600), (2, 5, 10), (3, 20, 600), (4, 1, 25)])
def test_equals_all_channel_pairs(spark, monkeypatch, seed, pool, large):
    for name, v in (("POOL", pool), ("TOP", pool), ("LARGE_BRAND", large)):
        monkeypatch.setattr(B, name, v)
    a, b = catalogs(spark, seed)
    fa, fb = counted(a, b)
    want = sorted(map(tuple, B.ranked(B.scored(B.channel_pairs(fa, fb), fa, fb)).collect()))
    assert sorted(map(tuple, B.retrieve(a, b, False).collect())) == want and want


def test_scores_are_the_sum_of_the_channels(spark):
    fa, fb = counted(*catalogs(spark, 7))
    sums = B.channels(fa, fb).groupBy("row_key", "b_index").agg(F.sum("w").alias("acc"), F.max(F.col("kind") == "brand").alias("by_brand"), F.max(F.col("kind") == "private").alias("by_private"), F.max(F.col("kind") == "exact").alias("protected"))
    got = B.scored(B.channel_pairs(fa, fb), fa, fb).select("row_key", "b_index", "acc", "by_brand", "by_private", "protected")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, sums.collect()))


def test_a_common_key_gives_few_proposals(spark):
    """A word and a number in every title, and a brand of all rows: proposals stay near the pool's size."""
    name = lambda c: F.concat(F.lit("plain soap 12 oz "), F.concat(F.lit("x"), F.hex(F.col(c) % 40)))
    cols = lambda c: ["item_id", "name", "brand_raw", *[F.lit("").alias(x) for x in ("description", "item_info", "sizing_comp", "tags")], c]
    make = lambda c: spark.range(800).withColumnRenamed("id", c).withColumns({"item_id": F.col(c).cast("string"), "name": name(c), "brand_raw": F.lit("acme")}).select(*cols(c))
    fa, fb = counted(make("row_key"), make("b_index"))
    folder = Folder(spark)
    assert B.channel_pairs(fa, fb).count() == 640_000
    assert topk.proposals(fa, index.of(make("b_index"), False), folder).count() <= 800 * 3 * B.POOL
    folder.drop()


def test_many_rows_of_one_title_give_few_proposals(spark):
    """Equal rows on both sides, of a large brand: not all of them are paired."""
    make = lambda c: spark.range(700).withColumnRenamed("id", c).selectExpr(f"cast({c} as string) item_id", "'plain soap 12 oz' name", "'acme' brand_raw", "'' description", "'' item_info", "'' sizing_comp", "'' tags", c)
    fa, _ = counted(make("row_key"), make("b_index"))
    folder = Folder(spark)
    assert topk.proposals(fa, index.of(make("b_index"), False, lambda _, df: folder.staged(df)), folder).count() == 700 * B.POOL
    folder.drop()
    got = B.retrieve(make("row_key"), make("b_index"), False).groupBy("row_key").agg(F.count("*").alias("n"), F.max("b_index").alias("last")).collect()
    assert len(got) == 700 and {(r.n, r.last) for r in got} == {(B.POOL, B.POOL - 1)}


def test_empty_catalogs(spark):
    a, b = catalogs(spark, 1)
    assert B.retrieve(a.limit(0), b, False).collect() == [] and B.retrieve(a, b.limit(0), False).collect() == []


def moved(df, name):
    """Scans of stored tables of that name that lie below an exchange before they meet a join, window or aggregate of another kind."""
    path, found = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-*|"))
        path = [x for x in path if x[0] < depth] + [(depth, line.strip(" :+-*|"))]
        if f"{name}_" in line and "Scan parquet" in line:
            above = next((x for _, x in reversed(path[:-1]) if re.match(r"(\(\d+\) )?(SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin|Exchange|BroadcastExchange)", x)), "")
            found.append((line, above))
    assert found
    return [scan for scan, above in found if "Exchange" in above]


def test_stored_tables_stay_where_they_are(spark, tmp_path, monkeypatch):
    a, b = catalogs(spark, 5)
    index.build(b, "kept", f"file://{tmp_path}/index", 4, False)
    want = sorted(map(tuple, B.retrieve(a, b, False).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = []
    try:
        real = Folder.staged
        monkeypatch.setattr(Folder, "staged", lambda self, df: plans.append(df) or real(self, df))
        monkeypatch.setattr(Folder, "result", lambda self, df: plans.append(df) or staged(df))
        assert sorted(map(tuple, B.retrieve(a, None, False, index.opened(spark, "kept")).collect())) == want
        used = [df for df in plans if "kept_" in df._jdf.queryExecution().executedPlan().toString()]
        scans = "".join(df._jdf.queryExecution().executedPlan().toString() for df in used)
        assert all(f"kept_{t}" in scans for t in index.TABLES)
        assert [moved(df, "kept") for df in used] == [[] for _ in used]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for t in index.TABLES:
            spark.sql(f"DROP TABLE IF EXISTS kept_{t}")
