"""Settings from files, kept facts and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from pairloom import __main__ as cli
from pairloom.operators import facts, routing
from pairloom.plans import stages
from pairloom.sources import catalog, config


def put(path, value):
    path.write_text("﻿" + json.dumps(value))
    return str(path)


def test_criteria_weigh_by_word(spark, tmp_path):
    rows = [("brand", "identity", "Fatal conflict"), ("scent", "form_variant", "STRONG"), ("color", "form_variant", "contextual"), ("texture", "form_variant", None)]
    path = put(tmp_path / "c.json", {"attributes": [dict(zip(("name", "group", "criticality"), r, strict=True)) for r in rows] + [{"name": "shade", "group": "form_variant", "weight": 4}]})
    assert [w for _, _, w in config.read_criteria(spark, f" '{path}' ")] == [7.0, 3.5, 1.5, 2.0, 4.0]


def test_thresholds_keep_defaults(spark, tmp_path):
    path = put(tmp_path / "t.json", {"router": {"same_brand_min_support": 0.2, "review_raw_max": 0.9, "nonmatch_raw_below": 0.3}, "calibration": {"match": {"intercept": -4.0}}})
    t, d = config.read_thresholds(spark, path), routing.Thresholds()
    assert t.same == (0.52, 0.82, 0.2, 0.01) and t.review_raw == (0.46, 0.9) and t.raw_below == 0.3 and t.match_intercept == -4.0
    assert (t.private, t.general, t.private_unknown, t.match_coefficient) == (d.private, d.general, d.private_unknown, d.match_coefficient)


def test_lexicon_of_a_caller(spark, tmp_path):
    pairs = config.read_lexicon(spark, put(tmp_path / "l.json", {"finish": ["matte", "satin"]}))
    p = spark.createDataFrame([(1, "Matte paint", *[""] * 5), (2, "", *[""] * 5), (3, None, *[None] * 5)], "row_key long, name string, description string, brand_raw string, item_info string, sizing_comp string, tags string")
    got = facts.extract(p, "row_key", pairs).where("attr = 'finish'").collect()
    assert [(r.row_key, r.toks) for r in got] == [(1, ["matte"])]


def test_one_file_whole(spark, tmp_path):
    path = str(tmp_path / "s.json")
    for n in (1, 2):
        config.write_json(spark.range(n).agg(F.count("*").alias("rows")), path)
    assert config.read_json(spark, path) == {"rows": 2} and config.only_match(spark, str(tmp_path / "s*.json")).endswith("s.json")
    with pytest.raises(ValueError):
        config.only_match(spark, str(tmp_path / "none*"))


def test_copy_is_made_once(spark, tmp_path):
    path = str(tmp_path / "s.json")
    config.write_json(spark.sql("SELECT 1 AS n"), path)
    copy = config.keep_copy(spark, path)
    config.write_json(spark.sql("SELECT 2 AS n"), path)
    assert config.keep_copy(spark, path) == copy and config.read_json(spark, copy) == {"n": 1}


def test_kept_rows_are_made_once(spark, tmp_path):
    made = []

    def make(p):
        made.append(sorted(r.k for r in p.collect()))
        return p.select("k", (F.col("k") * 10).alias("v"))

    path = str(tmp_path / "kept")
    for n in (3, 5, 2):
        got = stages.cached(spark.range(n).withColumnRenamed("id", "k"), "k", make, path)
        assert sorted((r.k, r.v) for r in got.collect()) == [(i, 10 * i) for i in range(n)]
    assert made == [[0, 1, 2], [3, 4]]


def test_command_line(spark, tmp_path, capsys):
    for name, title in (("a", "Zesty Apple Soda 12 oz"), ("b", "Zesty Apple Soda 12 oz")):
        (tmp_path / f"{name}.csv").write_text(f"item_id,name,brand_raw\n{name}1,{title},Zesty\n{name}2,Plain Rope,Other{name}\n")
    cli.main(["link", "--a", f"'{tmp_path}/a.csv'", "--b", f"{tmp_path}/b.csv", "--out", f"{tmp_path}/out", "--facts", f"{tmp_path}/facts"])
    assert config.read_json(spark, f"{tmp_path}/out/run_summary.json")["rows"] == 2
    found = f"{catalog.current(spark, f'{tmp_path}/out')}/submission_matches"
    pairs = spark.read.csv(found, header=True)
    assert ("a1", "b1") in [tuple(r) for r in pairs.collect()]
    cli.main(["compare", "--left", found, "--right", found])
    cli.main(["lookup", "--a", f"{tmp_path}/a.csv", "--query", "rope"])
    cli.main(["profile", "--a", f"{tmp_path}/a.csv"])
    out = capsys.readouterr().out
    assert "jaccard" in out and "Plain Rope" in out and "blank_share" in out


def test_a_failed_write_leaves_the_last_version(spark, tmp_path):
    path = f"{tmp_path}/out"
    table = lambda v: (lambda folder: spark.range(2).select("id", F.lit(v).alias("v")))
    copy = lambda folder: spark.read.csv(f"{folder}/x", header=True)

    def fails(folder):
        raise RuntimeError("lost")

    first = catalog.write_version({"x": table("old"), "y": copy}, spark, path)
    with pytest.raises(RuntimeError, match="lost"):
        catalog.write_version({"x": table("new"), "y": fails}, spark, path)
    assert catalog.current(spark, path) == first
    assert [{r.v for r in spark.read.csv(f"{first}/{n}", header=True).collect()} for n in "xy"] == [{"old"}, {"old"}]
    second = catalog.write_version({"x": table("new"), "y": copy}, spark, path)
    assert catalog.current(spark, path) == second != first and {r.v for r in spark.read.csv(f"{second}/y", header=True).collect()} == {"new"}
