"""Token budget of a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.fixed_values import ACCUMULATION_STEPS, BATCH_SIZE, MAX_SEQ_LEN


def tokens_per_step(
    batch_size: int = BATCH_SIZE, accumulation: int = ACCUMULATION_STEPS, max_seq_len: int = MAX_SEQ_LEN
) -> int:
    return batch_size * accumulation * max_seq_len


def corpus_report(
    counted: DataFrame, by: Sequence[str], n_tokens: str = "n_tokens", max_seq_len: int = MAX_SEQ_LEN,
    batch_size: int = BATCH_SIZE, accumulation: int = ACCUMULATION_STEPS, n_targets: str = "n_targets",
) -> DataFrame:
    """Per group: documents, tokens before and after the cut, padding, next-token targets,
    truncated documents, full batches and steps, and the token slots those steps take.

    ``n_targets`` counts the supervised targets of a document or conversation, from its labels.
    """
    tokens = F.col(n_tokens)
    kept = F.least(tokens, F.lit(max_seq_len))
    sums = counted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(tokens).alias("raw_tokens"),
        F.sum(kept).alias("kept_tokens"),
        F.sum(max_seq_len - kept).alias("pad_tokens"),
        F.sum(n_targets).alias("targets"),
        F.count_if(tokens > max_seq_len).alias("truncated"),
    )
    batches = F.floor(F.col("n_docs") / batch_size)
    steps = F.floor(F.col("n_batches") / accumulation)
    return (
        sums.withColumn("n_batches", batches)
        .withColumn("n_steps", steps)
        .withColumn("step_tokens", F.col("n_steps") * tokens_per_step(batch_size, accumulation, max_seq_len))
    )
