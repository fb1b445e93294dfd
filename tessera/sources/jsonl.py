"""JSON-lines files: reading with quarantine, appending."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_PAIRS_SCHEMA = "prompt string, completion_a string, completion_b string"
PREFERENCE_SCHEMA = "prompt string, chosen string, rejected string"
CORRUPT = "_corrupt_record"


def read_lines(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """Rows of a file with one JSON object per line; blank lines are skipped. A line that does not
    parse keeps its text in ``_corrupt_record``."""
    full = T._parse_datatype_string(schema).add(CORRUPT, "string")
    return spark.read.schema(full).option("columnNameOfCorruptRecord", CORRUPT).json(path)


def recover(rows: DataFrame, required: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with ``reason``): broken lines and rows that lack a field.

    Every row ends in exactly one of the two.
    """
    fields = [c for c in rows.columns if c != CORRUPT]
    missing = F.array_compact(
        F.array(*(F.when(F.col(f).isNull(), F.lit(f)) for f in required or fields))
    )
    reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed_line")).when(
        F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ", "))
    )
    marked = rows.withColumn("reason", reason)
    return (
        marked.where(F.col("reason").isNull()).select(*fields),
        marked.where(F.col("reason").isNotNull()),
    )


def append_lines(rows: DataFrame, path: str) -> None:
    """Add rows as JSON lines, one file per task; nothing shows until the whole write commits."""
    rows.write.mode("append").option("ignoreNullFields", "false").json(path)
