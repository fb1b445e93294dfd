"""Queries that write logs and ledgers as files and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.chat import judge_request
from tessera.operators import pairs as P
from tessera.operators import runs
from tessera.operators.replies import assemble_replies
from tessera.operators.requests import request_outcomes
from tessera.plans.chat import _OUTCOMES, CONTEXT
from tessera.plans.chat import QUERIES as CHAT
from tessera.plans.tables import JUDGED_SQL, RUN_LOG_SQL, raw_pairs, request_log, response_chunks, run_log, stub_judge
from tessera.session import scratch_path
from tessera.sources.ledger import append_ledger, read_ledger
from tessera.sources.logs import evaluations, read_chunks, read_request_log, read_run_log
from tessera.streaming.incremental import read_new_files
from tessera.streaming.replies import STATE_STORE, reply_stream

RUNS = 8


def run_files(spark: SparkSession, folder: str) -> DataFrame:
    """Run logs as JSON lines, one folder per run, read back and summed up."""
    path = scratch_path(spark, "runs")
    log = run_log(spark, folder).withColumn("r", F.col("run") % RUNS)
    log.select("r", "message", "step", "val_loss").write.partitionBy("r").json(path)
    read = read_run_log(spark, path)
    summary = runs.run_summary(read)
    measured = evaluations(read).groupBy("run").agg(F.round(F.avg("val_loss"), 6).alias("mean_loss"))
    return summary.join(measured, "run", "left")


def request_files(spark: SparkSession, folder: str) -> DataFrame:
    """Request payloads as lines, each twice, read back: equal payloads are requests of their own."""
    path = scratch_path(spark, "requests")
    payloads = request_log(spark, folder).select("payload")
    payloads.unionAll(payloads).write.text(path)
    read = request_outcomes(read_request_log(spark, path), max_seq_len=CONTEXT)
    return read.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("request_id").alias("n_ids"))


def chunk_files(spark: SparkSession, folder: str) -> DataFrame:
    """Response chunks as JSON lines, read back and put together."""
    path = scratch_path(spark, "chunks")
    response_chunks(spark, folder).withColumn("request_id", F.col("request_id").cast("string")).write.json(path)
    found = assemble_replies(read_chunks(spark, path))
    return found.select(F.col("request_id").cast("long").alias("request_id"), "reply", "status")


def streamed_replies(spark: SparkSession, folder: str) -> DataFrame:
    """Replies put together by a stream over the chunks in several files, stopped and started again; a last chunk
    of a later time lets it close what stays open."""
    chunks = response_chunks(spark, folder).withColumn("at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("seq") % 7))
    base = scratch_path(spark, "reply-stream")
    later = spark.createDataFrame([(-1, 1)], "request_id long, seq long").select(
        "request_id", "seq", F.lit(None).cast("string").alias("token"), F.lit(False).alias("done"),
        F.lit(None).cast("string").alias("error"), F.timestamp_seconds(F.lit(1_800_000_000)).alias("at"),
    )
    part = F.pmod(F.xxhash64("request_id", "seq"), F.lit(3)) == 0
    before = spark.conf.get(STATE_STORE[0], None)
    spark.conf.set(*STATE_STORE)
    try:
        for wave in (chunks.where(part), chunks.where(~part), later):
            wave.write.mode("append").parquet(f"{base}/in")
            stream = read_new_files(spark, f"{base}/in", chunks.schema).withWatermark("at", "1 minute")
            query = reply_stream(stream, 60).writeStream.format("parquet").option("path", f"{base}/out")
            query.option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(STATE_STORE[0]) if before is None else spark.conf.set(STATE_STORE[0], before)
    return spark.read.parquet(f"{base}/out").where("request_id >= 0")


def judge_progress(spark: SparkSession, folder: str) -> DataFrame:
    """A self-check, then the forward order judged into a ledger: what was observed while it was
    written, and what the ledger holds."""
    P.self_check(spark, lambda: lambda request: '{"reasoning": "known", "verdict": "A"}', retry_seconds=0)
    path = scratch_path(spark, "ledger")
    asked = raw_pairs(spark, folder).where(~P.is_degenerate(F.col("completion_a"), F.col("completion_b")))
    requests = asked.select("key", judge_request(F.col("prompt"), F.col("completion_a"), F.col("completion_b")).alias("request"))
    verdicts = P.judge_stage(requests, stub_judge, "key", retry_seconds=0)
    passed = F.count_if(F.col("status") == "ok").alias("with_verdict")
    seen = append_ledger(verdicts, path, passed)
    written = read_ledger(spark, path, verdicts.schema)
    return written.agg(
        F.lit(seen["rows"]).alias("observed"),
        F.lit(seen["with_verdict"]).alias("observed_verdicts"),
        F.count(F.lit(1)).alias("written"),
        passed.alias("written_verdicts"),
    )


QUERIES = {
    "run_files": (
        run_files,
        f"""WITH {RUN_LOG_SQL} SELECT 'r=' || (run % {RUNS}) AS run, max(step) AS last_step,
            arg_max(val_loss, step) FILTER (WHERE val_loss IS NOT NULL) AS last_val_loss,
            count(val_loss) AS n_evals, count(*) FILTER (WHERE message LIKE 'saved checkpoint%') AS n_checkpoints,
            count(*) AS n_records, round(avg(val_loss), 6) AS mean_loss FROM run_log GROUP BY run % {RUNS}""",
    ),
    "request_files": (
        request_files,
        f"WITH {_OUTCOMES} SELECT outcome, 2 * count(*) AS n, 2 * count(*) AS n_ids FROM outcomes GROUP BY outcome",
    ),
    "chunk_files": (chunk_files, CHAT["replies"][1]),
    "streamed_replies": (streamed_replies, CHAT["replies"][1]),
    "judge_progress": (
        judge_progress,
        f"""WITH {JUDGED_SQL}, n AS (
            SELECT count(*) AS asked, count(*) FILTER (WHERE early IS NULL) AS ok FROM judged
            WHERE discard_reason IS DISTINCT FROM 'degenerate_pair'
        )
        SELECT asked AS observed, ok AS observed_verdicts, asked AS written, ok AS written_verdicts FROM n""",
    ),
}
