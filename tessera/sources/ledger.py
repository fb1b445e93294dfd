"""Ledgers: tables of rows already processed, for resuming a job by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import path_exists, remove_path


def read_ledger(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The ledger's rows; empty when none were written yet."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def append_ledger(rows: DataFrame, path: str, *metrics: Column) -> dict:
    """Add rows and return the metrics observed while they were written (their number, and any
    given aggregates). The output committer makes each call all or nothing."""
    progress = Observation()
    observed = rows.observe(progress, F.count(F.lit(1)).alias("rows"), *metrics)
    observed.write.mode("append").parquet(path)
    return progress.get


def pending(rows: DataFrame, path: str, *keys: str) -> DataFrame:
    """Rows whose keys are not in the ledger. The ledger holds every row processed, kept or not, so
    the order or number of input rows does not matter."""
    done = read_ledger(rows.sparkSession, path, T.StructType([rows.schema[key] for key in keys]))
    return rows.join(done, list(keys), "left_anti")


def compact_ledger(spark: SparkSession, path: str, schema: T.StructType | str, *keys: str) -> None:
    """Write the ledger's many parts as few, one row for each of ``keys``.

    The rows are added in one commit before the old files go, so at every moment the ledger holds all of
    them; a stop in between leaves rows twice, never fewer.
    """
    if not path_exists(spark, path):
        return
    rows = spark.read.schema(schema).parquet(path)
    old = rows.inputFiles()
    rows.dropDuplicates(list(keys)).repartition(*(F.col(key) for key in keys)).write.mode("append").parquet(path)
    for file in old:
        remove_path(spark, file)
