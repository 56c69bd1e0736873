"""Every operator on odd rows: nulls, empty and very long texts, ties, repeated rows, empty tables, extra columns with any name."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pairloom.llm import decontaminate, fingerprints, language, line_dedup, log_bilinear, nearest, negatives, passages, quality, ranked, secrets, sentencepieces, simhash
from pairloom.llm.queries import tokenizer_model

from .conftest import words

#: Names that operators use for their results or inside.
CLASH = "id text_hash h h1 h2 key part place fp fps root node component component_id other doc span spans hits items n_words n_lines n_dropped lang_pred score row v q n rank teaches x label".split()


def table(spark, empty):
    rng = random.Random(1)
    long = " ".join(words(rng, 2000)) * 160
    texts = [None, "", " \n\t", "a", "same text of a few words here", "same text of a few words here", "# $ %", long, " ".join(words(rng, 60)), "token=abcdefgh1 and more"]
    rows = [(i, t, ["en", None][i % 2], f"s{i % 3}" if i % 4 else None, 1) for i, t in enumerate(texts)]
    rows += [rows[4], rows[8], rows[8], (None, texts[4], None, None, None), (None, None, None, None, None), (8, "another text under an id that is taken", "en", "s1", 2)]
    df = spark.createDataFrame([] if empty else rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(c).alias(c) for c in CLASH])


def items(spark):
    return spark.createDataFrame([(1, "another text under an id that is taken"), (2, None), (None, "x")], "item_id long, text string")


def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (6, 0, 0), (8, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "op1": lambda s, d: simhash.simhash_components(d),
    "near_copies": lambda s, d: simhash.near_copies(d),
    "op2": lambda s, d: quality.score_quality(d, labels(s), F.lit(True)),
    "op3": lambda s, d: secrets.find_secrets(d),
    "op4": lambda s, d: sentencepieces.encode(d, tokenizer_model(), results=sentencepieces.digest, schema=sentencepieces.DIGEST),
    "op5": lambda s, d: passages.passage_classes(d),
    "op6": lambda s, d: language.identify(d, language.fit(d), keep=tuple(d.columns)),
    "op7": lambda s, d: decontaminate.remove_hits(decontaminate.find_contamination(d, items(s), keep=tuple(d.columns))),
    "op8": lambda s, d: nearest.search(d.withColumn("embedding", F.when(F.col("doc_id") != 3, F.array(F.lit(1.0), F.col("doc_id").cast("double")))).withColumnRenamed("doc_id", "vec_id"), F.col("vec_id") % 4 == 0),
    "op9": lambda s, d: log_bilinear.score_texts(d, F.lit(True)),
    "op10": lambda s, d: line_dedup.drop_boilerplate(d),
    "op11": lambda s, d: fingerprints.document_fingerprints(d),
    "op12": lambda s, d: ranked.ranked_search(d, items(s)),
    "op13": lambda s, d: negatives.hard_negatives(d.withColumn("embedding", F.when(F.col("doc_id") != 3, F.array(F.lit(1.0), F.col("doc_id") / 8))).withColumnRenamed("doc_id", "vec_id"), F.col("vec_id") == 8, F.col("vec_id") % 2),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    docs = table(spark, False)
    got = OPERATORS[name](spark, docs).collect()
    if name not in ("op8", "op12", "op13", "near_copies"):
        assert len(got) == docs.count()
    assert OPERATORS[name](spark, table(spark, True)).collect() == []
    if name == "op6":
        assert {r.lang_pred for r in got} <= {"en", "und"} and all(r.h1 == "h1" and 0 <= r.score <= 1 for r in got)
    if name == "op5":
        assert {r.class_id for r in got if r.doc_id is not None} == set(range(10))
    if name == "op11":
        texts = {r.doc_id: [] for r in docs.collect()}
        for r in docs.collect():
            texts[r.doc_id].append(r.text or "")
        assert all(r.n_chars in map(len, texts[r.doc_id]) and len(r.fingerprint) == len(r.edited_fingerprint) == 512 for r in got)
        assert {r.class_id for r in got if r.doc_id in (0, 1, 2)} == {0} and {r.class_id for r in got if r.doc_id in (4, 5)} == {4}
        assert {r.fingerprint for r in got if r.doc_id in (0, 1, 2)} == {"".join(r.fingerprint for r in got if r.doc_id == 0)}
        assert all(r.class_id is None for r in got if r.doc_id is None)
    if name == "op12":
        # The title of item 1 is a text of document 8; the item without a text and the one without an id have no rows.
        assert {r.item_id for r in got} == {1} and (got[0].rank, got[0].doc_id) == (1, 8) and [r.rank for r in got] == list(range(1, len(got) + 1))
        assert all(x.score > y.score or x.score == y.score and x.doc_id <= y.doc_id for x, y in zip(got, got[1:], strict=False))
    if name == "op13":
        assert got and {r.anchor_id for r in got} == {8}
        assert all(30 * r.positive_score <= 100 * r.negative_score <= 90 * r.positive_score for r in got)
    if name == "near_copies":
        assert {(r.doc_id, r.component_id) for r in got if r.doc_id in (4, 5)} == {(4, 4), (5, 4)}
    if name == "op10":
        assert all(r.key == "key" and r.n_dropped == 0 for r in got)


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages(spark, tmp_path, empty):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = table(spark, empty)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        got = out.collect()
        assert all(r.key == "key" and r.score == "score" and r.n_dropped == "n_dropped" for r in got), name
        docs = spark.createDataFrame(got, docs.schema)
    got = sorted((str(r.doc_id), (r.text or "")[:12]) for r in docs.collect())
    assert got == ([] if empty else sorted([("3", "a"), ("4", "same text of"), ("7", got[2][1]), ("8", got[3][1]), ("9", "token=abcdef"), ("None", "same text of")]))
