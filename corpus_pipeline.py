"""From raw documents to token ids: toxic texts go, one of each group of near copies stays, personal data is
masked, sources are mixed to target weights, and what is left is encoded.

Each stage takes and returns documents (the last one returns ids' digests) and can be run alone; between stages
the documents are written to the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import byte_bpe, mixing, ngram_join, pii, toxicity
from faultline.plans.durable import shared_path

# Near copies within the pipeline: five words, a similarity of 0.8 or more.
WORDS = 5
PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select(F.struct(*docs.columns).alias("doc"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.where("score < 0.5").select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that of the smallest id.

    Rows are told apart by their own number: texts that repeat an id are no copies of each other unless they are alike, and
    rows without an id count by their text. Texts without words all stay.
    """
    return ngram_join.one_of_each(docs, size=WORDS, percent=PERCENT)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind, and the new number of characters."""
    text = docs.select(F.struct(*docs.columns).alias("doc"), pii.masked(F.col("text")).alias("masked"))
    changed = {"text": F.col("masked"), "n_chars": F.length("masked").cast("long")}
    return text.select(*[changed.get(c, F.col(f"doc.{c}")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in as many copies as their weight asks for, so that the drawn shares meet the targets."""
    return mixing.repeated(mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: number of ids, digests of the ids and of the bytes decoded from them."""
    coded = docs.select("doc_id", "source", "lang", byte_bpe.round_trip(F.col("text")).alias("coded"))
    return coded.select("doc_id", "source", "lang", "coded.*")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

# Classifier, link search and encoder have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
