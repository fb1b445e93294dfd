"""Run logs and request logs, always with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_LOG_SCHEMA = """
    message string, timestamp string, exc_info string, device string, step bigint, val_loss double,
    total bigint, resumed_from bigint, kept bigint, discard_counts map<string, bigint>,
    mean_length_ratio double
"""
CHUNKS_SCHEMA = "request_id string, seq bigint, token string, done boolean, error string"


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Run-log records with ``timestamp`` typed and ``run`` taken from the file's folder."""
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return (
        spark.read.schema(RUN_LOG_SCHEMA)
        .json(path)
        .withColumn("timestamp", F.try_to_timestamp("timestamp"))
        .withColumn("run", folder)
    )


def evaluations(log: DataFrame) -> DataFrame:
    return log.where(F.col("val_loss").isNotNull())


def read_request_log(spark: SparkSession, path: str) -> DataFrame:
    """One payload per line, kept as text. ``request_id`` is the payload's own ``id`` if it has one
    as text, else made of the file, the place of the split in it and the line in that, so equal
    payloads are requests of their own."""
    line = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).cast("string")
    place = F.concat_ws(
        ":", F.col("_metadata.file_path"), F.col("_metadata.file_block_start").cast("string"), line
    )
    own = F.try_variant_get(F.try_parse_json("value"), "$.id", "string")
    return spark.read.text(path).select(
        F.coalesce(own, F.sha2(place, 256)).alias("request_id"), F.col("value").alias("payload")
    )


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNKS_SCHEMA).json(path)
