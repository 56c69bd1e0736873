"""A corpus pipeline of five stages: language, boilerplate lines, near copies, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.  Columns of docs that a stage
doesn't use go through it under other names, so they may be called anything.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import decontaminate, language, line_dedup, sentencepieces, simhash
from pairloom.llm.common import counted, crc_mod, table, written
from pairloom.llm.queries import tokenizer_model

#: SQL can express neither the language model nor the tokenizer.
ORACLE_SQL = None
#: Columns that stages use.
USED = ("doc_id", "text", "lang", "source", "n_chars")


def _apart(docs: DataFrame) -> DataFrame:
    """docs with the columns that no stage uses renamed."""
    return docs.toDF(*[c if c in USED else f"__column_{i}" for i, c in enumerate(docs.columns)])


def _back(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, from a table made of _apart(docs)."""
    return out.select(*_apart(docs).columns).toDF(*docs.columns)


def _length(docs: DataFrame, changed: Column) -> Column:
    """n_chars, counted anew where the text was changed."""
    return F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; a null text or one without a letter goes.  Null ids and repeated rows stay."""
    model = language.fit(docs.where(crc_mod("doc_id", 3) != 1))
    rows = _apart(docs)
    return _back(language.identify(rows, model, keep=tuple(rows.columns)).where("lang_pred <> 'und'"), docs)


def line_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand on many sites; n_chars counts what is left.  Null texts, null ids and repeated rows stay."""
    out = line_dedup.drop_boilerplate(_apart(docs))
    return _back(out.withColumn("n_chars", _length(docs, F.col("n_dropped") > 0)) if "n_chars" in docs.columns else out, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Documents without an id stay.  Of rows with equal ids and texts one stays; rows with equal ids and different texts are one document, of which all texts
    stay or go; null and empty texts are copies of each other.
    """
    rows = _apart(docs)
    found = simhash.near_copies(rows)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    # Repeated rows are few: only they are compared whole.
    mark = F.xxhash64("text").alias("__text_hash")
    often = counted(written(rows.where("doc_id is not null").groupBy("doc_id", mark).agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "__text_hash")))
    rows = rows.join(gone, "doc_id", "left_anti").withColumn("__text_hash", mark)
    same = ["doc_id", "__text_hash"]
    kept = rows.join(often, same, "left_anti").unionByName(rows.join(often, same, "left_semi").dropDuplicates(["doc_id", "text"]))
    return _back(kept, docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated, without the spans of benchmark windows that they hold; n_chars counts what is left.

    Null texts have no words and stay, as do null ids and repeated rows.
    """
    rows = _apart(docs)
    found = decontaminate.find_contamination(rows, table(spark, sf_dir, "benchmark"), keep=tuple(rows.columns), left=decontaminate.own_text)
    clean = found.where(~decontaminate.contaminated())
    return _back(clean.withColumn("n_chars", _length(docs, F.size("hits") > 0)) if "n_chars" in docs.columns else clean, docs)


def _coded(encoder: sentencepieces.Encoder, texts: list[str]) -> dict[str, pa.Array]:
    got = sentencepieces.full(encoder, texts)
    return got | {"lossless": pa.array([a == b for a, b in zip(got["decoded"].to_pylist(), texts, strict=True)], pa.bool_())}


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, starts and ends (byte spans), and whether decoding gives the text back.  Null texts are empty; every row stays."""
    return sentencepieces.encode(docs, tokenizer_model(), results=_coded, schema="ids array<int>, starts array<int>, ends array<int>, lossless boolean")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_boilerplate),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_passages),
    ("sentencepiece", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs)
    return docs
