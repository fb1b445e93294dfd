"""From raw documents to token digests in five stages, each one operator of ``tessera.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, language, simhash, surrogates
from tessera.llm.batches import table
from tessera.llm.queries import SURROGATE_KEY
from tessera.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without a letter, and null texts, go."""
    return language.keep_language(docs, language.fit(docs, ~language.held_out()))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: that with the smallest id."""
    return simhash.without_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and secrets replaced; ``n_chars`` follows the new text."""
    changed = surrogates.replaced(docs, SURROGATE_KEY)
    return changed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else changed


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    import public_tokenizers

    return bpe.digests(bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("surrogates", replace_private),
    ("bpe", encode),
]

#: Several stages (trained profiles, keyed surrogates, merges) have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
