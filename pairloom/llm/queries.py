"""Queries opN_<name>: each applies its operator to a whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fingerprints, language, line_dedup, log_bilinear, nearest, negatives, passages, quality, ranked, secrets, sentencepieces, simhash
from .common import crc_mod, table

TOKENIZER = "piece_bpe_32k.model"


def tokenizer_model(path: str | None = None) -> bytes:
    """Bytes of the public tokenizer's model file, read on the driver."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    with open(path, "rb") as f:
        return f.read()


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_mod("doc_id", 4) != 2)
    return scored.select("doc_id", (~F.col("teaches")).alias("held_out"), "score", "predicted")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode(table(spark, sf_dir, "documents"), tokenizer_model(), results=sentencepieces.digest, schema=sentencepieces.DIGEST)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passage_classes(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.where(crc_mod("doc_id", 3) != 1))
    found = language.identify(docs, model)
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.array_sort("items"), ",")
    return found.select("doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"), decontaminate.contaminated().alias("contaminated"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = log_bilinear.score_texts(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) != 2)
    return scored.select("doc_id", (crc_mod("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5"), "text")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.document_fingerprints(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup, op2_quality, op3_secret_scan, op4_sentencepiece, op5_substring_dedup, op6_language_id, op7_decontaminate, op8_nearest_neighbours, op9_log_bilinear, op10_line_dedup,
        op11_fingerprints, op12_ranked_search, op13_hard_negatives,
    )
}
