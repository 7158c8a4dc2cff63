"""One query per operator over its whole table, with production parameters, and the SQL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import byte_bpe, inner_products, licenses, merkle, mixing, multi_index, ngram_join, pii, quality, token_store, toxicity, warc, whitening
from faultline.llm.batches import documents
from faultline.llm.checks import SQL as SQL


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select(
        "doc.doc_id",
        "source",
        "lang",
        "topic",
        "n_tokens",
        F.round("weight", 6).alias("weight"),
        F.round("probability", 6).alias("probability"),
        "drawn",
        F.round("expected_copies", 6).alias("expected_copies"),
        "copies",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = documents(spark, sf_dir).select("doc_id", licenses.licence_scan(F.col("text")).alias("found"))
    return found.select("doc_id", "found.*")


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_and_read(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_products.top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(documents(spark, sf_dir))


def op7_pii_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = documents(spark, sf_dir).select("doc_id", pii.personal_data(F.col("text")).alias("found"))
    return found.select("doc_id", "found.*")


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.stored_and_read(documents(spark, sf_dir))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = documents(spark, sf_dir).select("doc_id", byte_bpe.round_trip(F.col("text")).alias("coded"))
    return coded.select("doc_id", "coded.*")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_license_scan,
        op3_warc_revisits,
        op4_multi_index,
        op5_top_products,
        op6_ngram_join,
        op7_pii_offsets,
        op8_token_store,
        op9_byte_bpe,
        op10_toxicity,
        op11_quality_gam,
        op12_merkle_manifest,
        op13_embedding_whitening,
    )
}
