"""Training-run logs: summaries and the flat tail of the validation loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.fixed_values import EVAL_INTERVAL
from tessera.operators.skew import join_one_per_key
from tessera.session import scratch_path


def run_summary(log: DataFrame, run: str = "run") -> DataFrame:
    """Per run: last step, last validation loss, evaluations and checkpoints seen."""
    measured = F.col("val_loss").isNotNull()
    return log.groupBy(run).agg(
        F.max("step").alias("last_step"),
        F.max_by("val_loss", F.when(measured, F.col("step"))).alias("last_val_loss"),
        F.count_if(measured).alias("n_evals"),
        F.count_if(F.startswith("message", F.lit("saved checkpoint"))).alias("n_checkpoints"),
        F.count(F.lit(1)).alias("n_records"),
    )


def flat_tail(log: DataFrame, run: str = "run", window: int = EVAL_INTERVAL) -> DataFrame:
    """Per run, how much the validation loss fell over the first and the last ``window`` steps.

    The loss at a step is the latest one measured at or before it. A run may hold most of the
    log: the bounds of such runs are broadcast to their rows, and losses are picked map-side.
    """
    losses = log.where(F.col("val_loss").isNotNull()).select(run, "step", "val_loss")
    # One row per run, used four times below: written, so that the log is read for it only once.
    bounds = losses.groupBy(run).agg(
        F.min("step").alias("first_step"),
        F.max("step").alias("last_step"),
        F.count(F.lit(1)).alias("_rows"),
    )
    path = scratch_path(log.sparkSession, "bounds")
    bounds.write.parquet(path)
    bounds = log.sparkSession.read.schema(bounds.schema).parquet(path)
    step = F.col("step")
    placed = join_one_per_key(losses, bounds, [run], "_rows")

    def loss_at(limit: Column) -> Column:
        return F.max_by("val_loss", F.when(step <= limit, step))

    start, end = F.col("first_step"), F.col("last_step")
    return placed.groupBy(run).agg(
        (F.min_by("val_loss", "step") - loss_at(start + window)).alias("first_drop"),
        (loss_at(end - window) - F.max_by("val_loss", "step")).alias("last_drop"),
    )
