"""Queries over run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import runs
from tessera.plans.tables import RUN_LOG_SQL, run_log

WINDOW = 500


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return runs.run_summary(run_log(spark, folder))


def flat_tail(spark: SparkSession, folder: str) -> DataFrame:
    drops = runs.flat_tail(run_log(spark, folder), window=WINDOW)
    return drops.select(
        "run", F.round("first_drop", 6).alias("first_drop"), F.round("last_drop", 6).alias("last_drop")
    )


QUERIES = {
    "run_summary": (
        run_summary,
        f"""WITH {RUN_LOG_SQL} SELECT run, max(step) AS last_step,
            arg_max(val_loss, step) FILTER (WHERE val_loss IS NOT NULL) AS last_val_loss,
            count(val_loss) AS n_evals, count(*) FILTER (WHERE message LIKE 'saved checkpoint%') AS n_checkpoints,
            count(*) AS n_records FROM run_log GROUP BY run""",
    ),
    "flat_tail": (
        flat_tail,
        f"""WITH {RUN_LOG_SQL}, l AS (SELECT * FROM run_log WHERE val_loss IS NOT NULL),
        b AS (SELECT run, min(step) AS first, max(step) AS last FROM l GROUP BY run)
        SELECT l.run,
            round(arg_min(val_loss, step) - arg_max(val_loss, step) FILTER (WHERE step <= first + {WINDOW}), 6) AS first_drop,
            round(arg_max(val_loss, step) FILTER (WHERE step <= last - {WINDOW}) - arg_max(val_loss, step), 6) AS last_drop
        FROM l JOIN b ON b.run = l.run GROUP BY l.run""",
    ),
}
