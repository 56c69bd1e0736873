import random

import pytest

import corpus_pipeline
from pairloom.llm.queries import QUERIES, tokenizer_model

from .conftest import words

KIND = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rng = random.Random(12)
    item = " ".join(words(rng, 30))
    plain = [" ".join(words(rng, 80)) for _ in range(40)]
    rows = [(i, t, "en", f"s{i % 12}", len(t)) for i, t in enumerate(plain)]
    rows += [(40 + i, f"{' '.join(words(rng, 40))}\nSubscribe to us", "en", f"s{i % 12}", None) for i in range(30)]
    near = plain[3].split()
    near[50] = "changed"
    rows += [(70, " ".join(near), "en", "s1", 1), (71, plain[5], "en", "s2", 1), (72, f"{' '.join(words(rng, 20))} {item}", "en", "s3", 1)]
    rows += [(73, None, "en", "s1", None), (74, "", "en", None, 0), (75, "123 456", None, None, 7), (76, " ".join(words(rng, 8000)), None, None, None), (None, "tubako riko", None, None, None)]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, KIND).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (None, "x")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows


def test_each_stage_on_what_the_last_kept(spark, made):
    folder, rows = made
    docs, left = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        got = docs.collect()
        left[name] = {r.doc_id: r for r in got}
        docs = spark.createDataFrame(got, docs.schema)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = {r[0] for r in rows}
    assert set(left["language_id"]) == ids - {73, 74, 75}
    assert set(left["line_dedup"]) == ids - {73, 74, 75}
    assert sum("Subscribe" in (r.text or "") for r in left["line_dedup"].values()) == 1
    assert all(r.n_chars == len(r.text) for i, r in left["line_dedup"].items() if i is not None and 41 <= i < 70)
    assert set(left["simhash_near_dedup"]) == ids - {70, 71, 73, 74, 75}
    assert set(left["benchmark_decontamination"]) == ids - {70, 71, 72, 73, 74, 75}
    assert set(left["sentencepiece"]) == set(left["benchmark_decontamination"]) and all(r.lossless for r in left["sentencepiece"].values())


def test_run_applies_all_stages(spark, made):
    folder, rows = made
    got = corpus_pipeline.run(spark, folder)
    assert got.count() == len(rows) - 6 and set(got.columns) == {"doc_id", "ids", "starts", "ends", "lossless"}


def test_empty_documents(spark, made, tmp_path):
    folder, _ = made
    spark.createDataFrame([], KIND).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5 and len(tokenizer_model()) > 100_000
