"""The registered queries of the operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import alignment, archives, bpe, decontaminate, idfiles, language, nearest, pages, prefixes, repeats, simhash, surrogates, toxicity
from tessera.llm.batches import table
from tessera.session import scratch_path

#: The key of the surrogates. A deployment passes its own secret to ``surrogates.replaced``.
SURROGATE_KEY = "tessera"


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.linked(table(spark, folder, "documents"))


def op2_pages(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extracted(table(spark, folder, "pages"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = archives.archive_pages(table(spark, folder, "pages"), scratch_path(spark, "archives"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its new text and the number of mentions replaced."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.replaced(docs, SURROGATE_KEY, count="n_mentions")


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identified(table(spark, folder, "documents"))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents")
    return bpe.digests(bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json")))


def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digests(repeats.removed_words(table(spark, folder, "documents")))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(table(spark, folder, "embeddings"), every=100)


def op11_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, folder, "conversations"))


def op12_idfiles(spark: SparkSession, folder: str) -> DataFrame:
    """Where each document's ids stand in the files, how many they are, and their checksum."""
    import public_tokenizers

    docs, files = table(spark, folder, "documents"), scratch_path(spark, "ids")
    return idfiles.id_files(docs, public_tokenizers.path("word_bpe_49k.json"), 1, files)


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.alignments(table(spark, folder, "documents"), *paths)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_pages": op2_pages,
    "op3_warc": op3_warc,
    "op4_surrogates": op4_surrogates,
    "op5_language": op5_language,
    "op6_decontaminate": op6_decontaminate,
    "op7_bpe": op7_bpe,
    "op8_repeats": op8_repeats,
    "op9_toxicity": op9_toxicity,
    "op10_nearest": op10_nearest,
    "op11_prefixes": op11_prefixes,
    "op12_idfiles": op12_idfiles,
    "op13_alignment": op13_alignment,
}

SQL: dict[str, str] = {
    "op3_warc": archives.SQL,
    "op10_nearest": nearest.SQL,
    "op11_prefixes": prefixes.SQL,
}
