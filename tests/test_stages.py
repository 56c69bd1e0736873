"""Runs that go on where they were stopped, and facts kept by content."""

import pytest
from pyspark.sql import functions as F

from pairloom.operators import certify, facts
from pairloom.plans import link, stages

from .test_link import A, B, KIND


def catalogs(spark):
    make = lambda rows, key: spark.createDataFrame([(i, f"{key}{i}", n, b, "", "", "", "") for i, (n, b) in enumerate(rows)], f"{key} long, {KIND}")
    return make(A, "row_key"), make(B, "b_index")


def made(spark, path, inputs, names, settings=None):
    run = stages.Run(spark, path, inputs, settings)
    for n in names:
        run.stage(n, lambda n=n: spark.range(3).withColumn("name", F.lit(n)))
    return run.made


def test_finished_stages_are_read(spark, tmp_path):
    path, one = f"file://{tmp_path}/run", {"x": spark.range(5)}
    assert made(spark, path, one, "ab") == ["a", "b"] and made(spark, path, one, "abc") == ["c"]
    assert made(spark, path, {"x": spark.range(5).repartition(3)}, "abcd") == ["d"]
    (tmp_path / "run/b/_SUCCESS").unlink()  # as if the job had been stopped while it wrote
    assert made(spark, path, one, "abcd") == ["b"]
    with pytest.raises(ValueError, match="inputs: x"):
        made(spark, path, {"x": spark.range(6)}, "a")
    with pytest.raises(ValueError, match="settings"):
        made(spark, path, one, "a", settings=2)


def test_content_counts_repeated_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (2, "b")], "a int, b string")
    assert stages.content(df) == stages.content(df.orderBy(F.desc("a"))) != stages.content(df.distinct())
    assert stages.content(df.limit(0)) != stages.content(df.select("a").limit(0))


def test_a_stopped_link_goes_on(spark, tmp_path, monkeypatch):
    a, b = catalogs(spark)
    settings = link.Settings(unicode=False, run_path=f"file://{tmp_path}/run")
    want = sorted(map(str, link.link(a, b, settings=link.Settings(unicode=False)).collect()))
    real, calls = certify.certify, []
    monkeypatch.setattr(certify, "certify", lambda *args: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        link.link(a, b, settings=settings)
    monkeypatch.setattr(certify, "certify", lambda *args: calls.append(1) or real(*args))
    monkeypatch.setattr(facts, "extract", lambda *args: pytest.fail("made again"))
    assert sorted(map(str, link.link(a, b, settings=settings).collect())) == want and calls == [1]


def test_facts_follow_the_content(spark, tmp_path):
    path, asked = f"file://{tmp_path}/facts", []

    def make(df):
        asked.append(sorted(r.k for r in df.collect()))
        return df.where("name <> 'none'").select("k", F.upper("name").alias("fact"))

    def get(rows, version=""):
        df = spark.createDataFrame(rows, "k long, name string, note string")
        return sorted((r.k, r.fact) for r in stages.cached(df, "k", make, path, version).collect())

    old = [(1, "a", None), (2, "b", ""), (3, "none", "")]
    assert get(old) == [(1, "A"), (2, "B")] and get(old) == [(1, "A"), (2, "B")]
    new = [(1, "a", None), (2, "c", ""), (3, "none", "")]
    assert get(new) == [(1, "A"), (2, "C")] and get(old) == [(1, "A"), (2, "B")]
    assert asked == [[1, 2, 3], [2]]
    assert get(new[:1]) == [(1, "A")] and get(new, "other lexicon") == [(1, "A"), (2, "C")] and asked[2:] == [[1, 2, 3]]
    stages.compacted(spark.createDataFrame(new, "k long, name string, note string"), "k", path, f"{path}-2")
    assert sorted((r.k, r.fact) for r in spark.read.parquet(f"{path}-2/rows").collect()) == [(1, "A"), (2, "C")]
    path = f"{path}-2"
    assert get(new) == [(1, "A"), (2, "C")] and len(asked) == 3
    # Rows of a batch that was cut off before it was entered aren't read.
    spark.createDataFrame([(1, "LOST", "x", "cut")], "k long, fact string, __content string, __batch string").write.mode("append").parquet(f"{path}/rows")
    assert get(new) == [(1, "A"), (2, "C")]


def test_linkage_broadcasts_nothing_by_its_guessed_size(spark):
    a, b = catalogs(spark)
    a, b, plans = stages.staged(a), stages.staged(b), {}

    def keep(name, make):
        df = make()
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        if name == "facts_a":
            raise InterruptedError
        return stages.staged(df)

    with pytest.raises(InterruptedError):
        link.provisional(a, b, link.Settings(unicode=False), keep=keep)
    # These tables are tiny: left to itself Spark broadcasts them all.
    assert "Join" in plans["pairs"] and not [name for name in ("pairs", "facts_a") if "Broadcast" in plans[name]]
    joined = lambda: a.join(b, "name")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in joined()
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "77")
    try:
        with stages.unguessed(spark):
            assert "Broadcast" not in joined()
        assert spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == "77"
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
