"""A source catalog that arrives in batches gives what it gives at once, also after a failure between them."""

import pytest

from pairloom.plans import link
from pairloom.streaming import arrivals

from .test_stages import catalogs


def feed(spark, a, tmp_path, parts=3):
    for k in range(parts):
        a.where(f"row_key % {parts} = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/source")
    return spark.readStream.schema(a.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/source")


def test_three_batches_and_a_restart(spark, tmp_path, monkeypatch):
    a, b = catalogs(spark)
    s, path = link.Settings(unicode=False), f"file://{tmp_path}/out"
    want = sorted(map(str, link.link(a, b, settings=s).select("row_key", "final_verdict", "selected_item_id_B", "decision_reason").collect()))
    stream, real, calls = feed(spark, a, tmp_path), link.provisional, []

    def fails_once(rows, *args):
        calls.append(sorted(r.row_key for r in rows.collect()))
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(rows, *args)

    monkeypatch.setattr(link, "provisional", fails_once)
    with pytest.raises(Exception, match="lost"):
        arrivals.link_arrivals(stream, b, path, s).awaitTermination()
    arrivals.link_arrivals(stream, b, path, s).awaitTermination()
    assert len(calls) == 4 and calls[1] == calls[2]
    got = arrivals.settled(spark, b, path).select("row_key", "final_verdict", "selected_item_id_B", "decision_reason")
    assert sorted(map(str, got.collect())) == want


def test_a_later_row_of_a_key_wins(spark, tmp_path):
    first, second = (spark.createDataFrame([(1, x), (k, "other")], "row_key long, v string") for k, x in ((2, "old"), (3, "new")))
    path = f"file://{tmp_path}/out"
    for k, df in enumerate((first, second)):
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/source")
        arrivals.arrive(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/source"), lambda rows: rows, path).awaitTermination()
        assert arrivals.arrived(spark, path).count() == 2 + k
    assert sorted(map(tuple, arrivals.arrived(spark, path).collect())) == [(1, "new"), (2, "other"), (3, "other")]
    with pytest.raises(ValueError, match="nothing has arrived"):
        arrivals.settled(spark, first, f"{path}-none")
