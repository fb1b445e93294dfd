"""Answer pairs and their judging into preference pairs.

Calls to a model or a judge cost money, so each stage is written before it is used and a row is
identified by its key and what was asked: a second run reads what is there and calls only for what is missing.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.fixed_values import (
    DISCARD_REASONS,
    JUDGE_MAX_ATTEMPTS,
    JUDGE_RETRY_SECONDS,
    SELF_CHECK_PAIR,
)
from tessera.functions.chat import format_prompt, judge_request
from tessera.functions.words import is_blank
from tessera.operators.encoding import decode_ids, encode_ids
from tessera.operators.vocabulary import Vocabulary
from tessera.session import scratch_path
from tessera.sources.ledger import append_ledger, pending, read_ledger

logger = logging.getLogger(__name__)

# Given a list of token-id prompts and the sample's number, the full id sequences.
Completer = Callable[[list[list[int]], int], list[list[int]]]
# Given the request text, the judge's raw answer; raises on transport errors.
Judge = Callable[[str], "str | None"]

# Calls to a judge between two commits, on average.
ROWS_PER_COMMIT = 10_000
# Requests of a batch that a task has asked about before it passes the answers on.
ROWS_IN_HAND = 256

VERDICTS_SCHEMA = "status string, verdict string, content string, attempts int"


def sample_pairs(
    prompts: DataFrame, completer_factory: Callable[[], Completer], vocab: Vocabulary | None = None,
    key: str = "key", prompt: str = "prompt",
) -> DataFrame:
    """(key, prompt, completion_a, completion_b): two independent completions of every prompt.

    The factory runs once per task, so models are loaded on the workers and never shipped. The
    prompt's own tokens are cut off before decoding.
    """
    spark = prompts.sparkSession
    vocab = vocab or Vocabulary()
    coded = prompts.select(
        key, prompt, encode_ids(format_prompt(F.col(prompt)), vocab, spark).alias("_ids")
    )

    def complete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        completer = completer_factory()
        for batch in batches:
            ids = [list(map(int, row)) for row in batch["_ids"]]
            yield batch.assign(_a=completer(ids, 0), _b=completer(ids, 1))

    ids_type = T.ArrayType(T.IntegerType())
    schema = T.StructType([*coded.schema.fields, T.StructField("_a", ids_type), T.StructField("_b", ids_type)])
    full = coded.mapInPandas(complete, schema)

    def answer(name: str) -> Column:
        tail = F.slice(name, F.size("_ids") + 1, F.greatest(F.size(name) - F.size("_ids"), F.lit(0)))
        return decode_ids(tail, vocab, spark)

    return full.select(
        key, prompt, answer("_a").alias("completion_a"), answer("_b").alias("completion_b")
    )


def generate_pairs(
    prompts: DataFrame, completer_factory: Callable[[], Completer], path: str,
    vocab: Vocabulary | None = None, key: str = "key", prompt: str = "prompt", commits: int = 1,
) -> DataFrame:
    """``sample_pairs`` written below ``path``; prompts already answered there are not asked again.

    The table at ``path`` is its own ledger. It grows in ``commits`` equal parts, so that is what
    an interruption can lose.
    """
    for part in range(commits):
        share = prompts.where(F.pmod(F.xxhash64(key), F.lit(commits)) == part)
        pairs = sample_pairs(pending(share, path, key), completer_factory, vocab, key, prompt)
        logger.info("pairs part %d of %d: %s", part + 1, commits, append_ledger(pairs, path))
    return read_ledger(prompts.sparkSession, path, pairs.schema)


def is_degenerate(a: Column, b: Column) -> Column:
    """Equal or blank answers, which are dropped without asking the judge."""
    return (a == b) | is_blank(a) | is_blank(b)


def read_verdict(content: str | None) -> tuple[str, str | None]:
    """('ok', 'A' or 'B'), ('parse_failure', None), or ('retry', None) for JSON that is no object."""
    try:
        answer = json.loads(content)
    except (TypeError, ValueError):
        return "parse_failure", None
    if not isinstance(answer, dict):
        return "retry", None
    verdict = answer.get("verdict")
    return ("ok", verdict) if verdict in ("A", "B") else ("parse_failure", None)


def ask(judge: Judge, request: str, max_attempts: int, retry_seconds: float, backoff: float = 1.0) -> dict:
    """One judge call with retries for transient errors; unusable answers are not retried. Each pause is
    ``backoff`` times the one before."""
    content = None
    for attempt in range(1, max_attempts + 1):
        try:
            content = judge(request)
        except Exception:  # noqa: BLE001 - any client error counts as transient
            status = "retry"
        else:
            status, verdict = read_verdict(content)
            if status != "retry":
                return {"status": status, "verdict": verdict, "content": content, "attempts": attempt}
        if attempt < max_attempts:
            time.sleep(retry_seconds * backoff ** (attempt - 1))
    return {"status": "api_failure", "verdict": None, "content": content, "attempts": max_attempts}


def _in_hand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in order, ``ROWS_IN_HAND`` at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_IN_HAND):
            yield batch.slice(start, ROWS_IN_HAND)


def judge_stage(
    requests: DataFrame, judge_factory: Callable[[], Judge], key: str = "key",
    max_attempts: int = JUDGE_MAX_ATTEMPTS, retry_seconds: float = JUDGE_RETRY_SECONDS,
    in_flight: int = 1, backoff: float = 1.0,
) -> DataFrame:
    """(key, status, verdict, content, attempts) for every (key, request); other columns stand beside the key.

    A task keeps up to ``in_flight`` calls going at a time, so a judge made by the factory must then be safe to call
    from several threads. Answers are put back in the order of the requests.
    """
    kept = [key, *(c for c in requests.columns if c not in (key, "request"))]
    columns = requests.select(*kept, "request")
    fields = [*(columns.schema[c] for c in kept), *T._parse_datatype_string(VERDICTS_SCHEMA).fields]
    answer_schema = pa.schema([("status", pa.string()), ("verdict", pa.string()), ("content", pa.string()), ("attempts", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = judge_factory()
        with ThreadPoolExecutor(in_flight) as pool:
            for batch in _in_hand(batches):
                answers = list(pool.map(lambda r: ask(judge, r, max_attempts, retry_seconds, backoff), batch["request"].to_pylist()))
                answered = pa.RecordBatch.from_pylist(answers, answer_schema)
                yield pa.RecordBatch.from_arrays([*map(batch.column, kept), *answered.columns], names=[*kept, *answered.schema.names])

    return columns.mapInArrow(run, T.StructType(fields))


def judge_pairs(
    pairs: DataFrame, judge_factory: Callable[[], Judge], ledger: str, key: str = "key",
    max_attempts: int = JUDGE_MAX_ATTEMPTS, retry_seconds: float = JUDGE_RETRY_SECONDS,
    concurrency: int | None = None, rows_per_commit: int = ROWS_PER_COMMIT,
    in_flight: int = 1, backoff: float = 1.0,
) -> DataFrame:
    """Judge (key, prompt, completion_a, completion_b) in both orders; see ``decide``.

    Degenerate pairs are never asked about, and the swapped order only where the forward order
    gave a verdict. Both orders are kept in tables below ``ledger``, by key and a digest of what was asked, so an
    interrupted run goes on where it stopped, and a pair whose prompt or answers have changed
    meanwhile is asked about anew. ``concurrency`` bounds the number of tasks at a time, ``in_flight`` the calls
    of each. Each stage is
    written in parts of about ``rows_per_commit`` rows: what an interruption can lose is one part. Pairs
    and requests are written before they are used, so both orders and the result see the same ones, even where a plan that
    calls a model made them.
    """
    spark = pairs.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    pairs = written(pairs, "pairs")
    a, b = F.col("completion_a"), F.col("completion_b")
    askable = pairs.where(~is_degenerate(a, b))

    def stage(name: str, todo: DataFrame, first: Column, second: Column) -> DataFrame:
        path = f"{ledger}/{name}"
        asked = todo.select(key, judge_request(F.col("prompt"), first, second).alias("request"))
        asked = asked.withColumn("request_id", F.sha2("request", 256))
        left = written(pending(asked, path, key, "request_id"), "requests")
        commits = -(-left.count() // rows_per_commit)
        for part in range(commits):
            share = left.where(F.pmod(F.xxhash64(key), F.lit(commits)) == part)
            if concurrency is not None:
                share = share.repartition(concurrency)
            verdicts = judge_stage(share, judge_factory, key, max_attempts, retry_seconds, in_flight, backoff)
            passed = F.count_if(F.col("status") == "ok").alias("with_verdict")
            progress = append_ledger(verdicts, path, passed)
            logger.info("%s part %d of %d: %s", name, part + 1, commits, progress)
        verdicts = judge_stage(left, judge_factory, key, max_attempts, retry_seconds).schema
        known = read_ledger(spark, path, verdicts).join(asked.select(key, "request_id"), [key, "request_id"], "left_semi")
        # A compaction that stopped half-way leaves rows twice.
        return known.dropDuplicates([key, "request_id"])

    forward = stage("forward", askable, a, b)
    passed = forward.where(F.col("status") == "ok").select(key)
    swapped = stage("swapped", askable.join(passed, key, "left_semi"), b, a)
    return decide(pairs, forward, swapped, key)


def decide(pairs: DataFrame, forward: DataFrame, swapped: DataFrame, key: str = "key") -> DataFrame:
    """(key, prompt, kept, chosen, rejected, discard_reason, length_ratio, forward_verdict,
    swapped_verdict) of every pair."""
    def named(stage: DataFrame, prefix: str) -> DataFrame:
        return stage.select(
            key, F.col("status").alias(f"_{prefix}"), F.col("verdict").alias(f"{prefix}_verdict")
        )

    a, b = F.col("completion_a"), F.col("completion_b")
    first, second = F.col("_forward"), F.col("_swapped")
    forward_takes_a = F.col("forward_verdict") == "A"
    swapped_takes_a = F.col("swapped_verdict") == "B"
    reason = (
        F.when(is_degenerate(a, b), F.lit("degenerate_pair"))
        .when(first != "ok", first)
        .when(second != "ok", second)
        .when(first.isNull() | second.isNull(), F.lit("not_judged"))
        .when(forward_takes_a != swapped_takes_a, F.lit("position_bias_disagreement"))
    )
    chosen = F.when(forward_takes_a, a).otherwise(b)
    rejected = F.when(forward_takes_a, b).otherwise(a)
    judged = (
        pairs.join(named(forward, "forward"), key, "left")
        .join(named(swapped, "swapped"), key, "left")
        .withColumn("discard_reason", reason)
    )
    kept = F.col("discard_reason").isNull()
    return judged.select(
        key,
        "prompt",
        kept.alias("kept"),
        F.when(kept, chosen).alias("chosen"),
        F.when(kept, rejected).alias("rejected"),
        "discard_reason",
        F.when(
            kept, F.char_length(chosen) / F.greatest(F.char_length(rejected), F.lit(1))
        ).alias("length_ratio"),
        "forward_verdict",
        "swapped_verdict",
    )


def judge_summary(judged: DataFrame) -> DataFrame:
    """One row: pairs in all, pairs kept, one count per discard reason, mean length ratio."""
    reason = F.col("discard_reason")
    return judged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("kept")).alias("kept"),
        *(F.count_if(reason == name).alias(name) for name in DISCARD_REASONS),
        F.count_if(reason == "not_judged").alias("not_judged"),
        F.avg("length_ratio").alias("mean_length_ratio"),
    )


def judge_bias(judged: DataFrame) -> DataFrame:
    """Per order, how often the first answer shown wins, and how often both orders agree."""
    both = judged.where(F.col("forward_verdict").isNotNull() & F.col("swapped_verdict").isNotNull())
    agree = (F.col("forward_verdict") != F.col("swapped_verdict")).cast("double")
    orders = F.explode(
        F.array(
            F.struct(F.lit("forward").alias("order"), F.col("forward_verdict").alias("verdict")),
            F.struct(F.lit("swapped").alias("order"), F.col("swapped_verdict").alias("verdict")),
        )
    )
    return (
        both.select(orders.alias("o"), agree.alias("agree"))
        .groupBy(F.col("o.order").alias("order"))
        .agg(
            F.avg((F.col("o.verdict") == "A").cast("double")).alias("a_rate"),
            F.avg("agree").alias("agreement"),
        )
    )


def self_check(
    spark: SparkSession, judge_factory: Callable[[], Judge],
    max_attempts: int = JUDGE_MAX_ATTEMPTS, retry_seconds: float = JUDGE_RETRY_SECONDS,
) -> None:
    """Ask about one known pair before a paid batch; raise when no valid verdict comes back."""
    prompt, good, bad = (F.lit(x) for x in SELF_CHECK_PAIR)
    request = spark.range(1).select(F.col("id").alias("key"), judge_request(prompt, good, bad).alias("request"))
    answer = judge_stage(request, judge_factory, "key", max_attempts, retry_seconds).first()
    if answer["status"] != "ok":
        raise RuntimeError(f"judge self-check failed: {answer['status']}, answer {answer['content']!r}")


def preference_pairs(judged: DataFrame) -> DataFrame:
    """(prompt, chosen, rejected) of the pairs kept."""
    return judged.where(F.col("kept")).select("prompt", "chosen", "rejected")


def preference_metrics(scored: DataFrame, beta: float, *by: str) -> DataFrame:
    """Reward accuracy, margin and loss from (policy_chosen, policy_rejected, ref_chosen,
    ref_rejected) log-probabilities."""
    chosen = beta * (F.col("policy_chosen") - F.col("ref_chosen"))
    rejected = beta * (F.col("policy_rejected") - F.col("ref_rejected"))
    margin = chosen - rejected
    # log(1 + exp(-m)) without overflow for very negative margins.
    loss = F.log1p(F.exp(-F.abs(margin))) + F.greatest(-margin, F.lit(0.0))
    return scored.groupBy(*by).agg(
        F.avg((chosen > rejected).cast("double")).alias("accuracy"),
        F.avg(margin).alias("margin"),
        F.avg(loss).alias("loss"),
        F.count(F.lit(1)).alias("n_pairs"),
    )
