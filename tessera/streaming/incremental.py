"""Incremental jobs: files are read once each, across restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.fixed_values import MAX_SEQ_LEN
from tessera.operators.examples import pretraining_examples
from tessera.operators.pairs import Judge, judge_pairs, preference_pairs
from tessera.operators.vocabulary import Vocabulary


def read_new_files(
    spark: SparkSession, path: str, schema: T.StructType | str, source: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(source).load(path)


def encode_stream(
    docs: DataFrame, output: str, checkpoint: str, vocab: Vocabulary | None = None,
    max_seq_len: int = MAX_SEQ_LEN,
) -> StreamingQuery:
    """Write training examples of all files not read before, then stop. The checkpoint and the
    file sink's log make every input row appear exactly once, however often this is restarted."""
    return (
        pretraining_examples(docs, vocab, max_seq_len)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def judge_stream(
    pairs: DataFrame, judge_factory: Callable[[], Judge], ledger: str, output: str, checkpoint: str,
    key: str = "key", **judging,
) -> StreamingQuery:
    """Judge new pair files batch by batch and append the pairs kept as JSON lines.

    A batch that is run again after a failure finds its verdicts in its own part of the ledger and
    makes no call twice; its output folder is overwritten, so no pair is written twice either.
    """
    def one_batch(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            judged = judge_pairs(
                batch, judge_factory, f"{ledger}/batch={number}", key, **judging
            )
            preference_pairs(judged).write.mode("overwrite").json(f"{output}/batch={number}")
        finally:
            batch.unpersist()

    return (
        pairs.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def generate_stream(
    prompts: DataFrame, sampler: Callable[[DataFrame], DataFrame], output: str, checkpoint: str
) -> StreamingQuery:
    """Append answer pairs for new prompt files as JSON lines."""
    return (
        sampler(prompts)
        .writeStream.format("json")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
