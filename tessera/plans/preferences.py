"""Queries over answer pairs and their judging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixed_values import DPO_BETA, JUDGE_TEMPLATE
from tessera.functions.chat import judge_request
from tessera.functions.sequences import ids_digest
from tessera.operators import pairs as P
from tessera.operators.examples import preference_examples, preference_prompts
from tessera.plans.sql import byte_ids, fitted, prompt_markup
from tessera.plans.tables import (
    JUDGED_SQL,
    RAW_PAIRS_SQL,
    log_prob_pairs,
    raw_pairs,
    stub_judge,
    table,
)
from tessera.session import scratch_path
from tessera.sources.corpora import first_prompts
from tessera.sources.jsonl import RAW_PAIRS_SCHEMA, append_lines, read_lines, recover
from tessera.sources.ledger import append_ledger, pending
from tessera.operators.conversations import heads

PROMPTS = 30
MAX_LENGTH = 1024


def prompts(spark: SparkSession, folder: str) -> DataFrame:
    """The first message of the first conversations."""
    nested = heads(table(spark, folder, "conversations"), 1).withColumnRenamed("messages", "prompt")
    return first_prompts(nested, "conv_id", PROMPTS)


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    return raw_pairs(spark, folder)


def stub_completer():
    """A model stand-in: repeats its prompt once, or twice for the second sample."""
    def complete(prompts: list[list[int]], sample: int) -> list[list[int]]:
        return [ids * (2 + sample) for ids in prompts]

    return complete


def sampled_pairs(spark: SparkSession, folder: str) -> DataFrame:
    asked = raw_pairs(spark, folder).select("key", "prompt")
    return P.sample_pairs(asked, stub_completer)


def degenerate_pairs(spark: SparkSession, folder: str) -> DataFrame:
    found = raw_pairs(spark, folder).where(P.is_degenerate(F.col("completion_a"), F.col("completion_b")))
    return found.select("key", F.lit("degenerate_pair").alias("reason"))


def judge_requests(spark: SparkSession, folder: str) -> DataFrame:
    request = judge_request(F.col("prompt"), F.col("completion_a"), F.col("completion_b"))
    return raw_pairs(spark, folder).select("key", F.md5(request).alias("request_md5"))


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    ledger = scratch_path(spark, "judged")
    return P.judge_pairs(raw_pairs(spark, folder), stub_judge, ledger, retry_seconds=0.0)


def judged_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return _judged(spark, folder).select(
        "key", "kept", "discard_reason", "chosen", "rejected", F.round("length_ratio", 6).alias("length_ratio")
    )


def judge_summary(spark: SparkSession, folder: str) -> DataFrame:
    return P.judge_summary(_judged(spark, folder)).withColumn(
        "mean_length_ratio", F.round("mean_length_ratio", 6)
    )


def judge_bias(spark: SparkSession, folder: str) -> DataFrame:
    return P.judge_bias(_judged(spark, folder)).select(
        "order", F.round("a_rate", 6).alias("a_rate"), F.round("agreement", 6).alias("agreement")
    )


def resume_todo(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs left to judge when a third of the keys is in the ledger."""
    rows = raw_pairs(spark, folder)
    ledger = scratch_path(spark, "resume")
    append_ledger(rows.where(F.col("key") % 3 == 0).select("key"), ledger)
    return pending(rows, ledger, "key").select("key")


def preference_set(spark: SparkSession, folder: str) -> DataFrame:
    kept = preference_prompts(_judged(spark, folder).where("kept").select("key", "prompt", "chosen", "rejected"))
    coded = preference_examples(kept, max_length=MAX_LENGTH)
    return coded.select(
        "key", "prompt", "chosen", "rejected", F.size("prompt_ids").alias("n_prompt"),
        ids_digest(F.col("chosen_ids")).alias("chosen_md5"),
        ids_digest(F.col("rejected_ids")).alias("rejected_md5"),
        ids_digest(F.col("chosen_mask")).alias("chosen_mask_md5"),
        ids_digest(F.col("rejected_mask")).alias("rejected_mask_md5"),
    )


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = P.preference_metrics(log_prob_pairs(spark, folder), DPO_BETA, "l_returnflag")
    return found.select(
        "l_returnflag", "n_pairs", *(F.round(c, 6).alias(c) for c in ("accuracy", "margin", "loss"))
    )


def jsonl_recovery(spark: SparkSession, folder: str) -> DataFrame:
    """Answer pairs written as JSON lines with damage of every kind, read back and sorted out."""
    path = scratch_path(spark, "lines")
    key = F.col("key")
    line = F.to_json(F.struct("prompt", "completion_a", "completion_b"))
    damaged = (
        F.when(key % 10 == 1, F.substring(line, 1, 20))
        .when(key % 10 == 2, F.lit("\0" * 40))
        .when(key % 10 == 4, F.to_json(F.struct("prompt", "completion_a")))
        .when(key % 10 == 5, F.lit(""))
        .otherwise(line)
    )
    raw_pairs(spark, folder).select(damaged.alias("value")).write.text(f"{path}/raw")
    good, bad = recover(read_lines(spark, f"{path}/raw", RAW_PAIRS_SCHEMA))
    append_lines(good, f"{path}/clean")
    clean = spark.read.schema(RAW_PAIRS_SCHEMA).json(f"{path}/clean").select(F.lit("good").alias("reason"))
    return clean.unionByName(bad.select("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _text(template: str) -> str:
    return "'" + template.replace("'", "''") + "'"


def _judge_request_sql() -> str:
    filled = _text(JUDGE_TEMPLATE)
    for slot, column in (("{prompt}", "prompt"), ("{response_a}", "completion_a"), ("{response_b}", "completion_b")):
        filled = filled.replace(slot, f"' || {column} || '")
    return filled


_WRAPPED = prompt_markup("prompt")
_ENDED = {c: f"list_append({byte_ids(c)}, 1)" for c in ("chosen", "rejected")}
QUERIES = {
    "first_prompts": (
        prompts,
        f"""SELECT conv_id, arg_min(text, turn) AS prompt FROM conversations GROUP BY conv_id
        ORDER BY conv_id LIMIT {PROMPTS}""",
    ),
    "raw_pairs": (pairs, f"WITH {RAW_PAIRS_SQL} SELECT key, prompt, completion_a, completion_b FROM raw_pairs"),
    "sampled_pairs": (
        sampled_pairs,
        f"""WITH {RAW_PAIRS_SQL} SELECT key, prompt, {_WRAPPED} AS completion_a,
            {_WRAPPED} || {_WRAPPED} AS completion_b FROM raw_pairs""",
    ),
    "degenerate_pairs": (
        degenerate_pairs,
        f"WITH {JUDGED_SQL} SELECT key, 'degenerate_pair' AS reason FROM sized WHERE degenerate",
    ),
    "judge_requests": (
        judge_requests,
        f"WITH {RAW_PAIRS_SQL} SELECT key, md5({_judge_request_sql()}) AS request_md5 FROM raw_pairs",
    ),
    "judged_pairs": (
        judged_pairs,
        f"""WITH {JUDGED_SQL} SELECT key, kept, discard_reason, chosen, rejected,
            round(length_ratio, 6) AS length_ratio FROM judged""",
    ),
    "judge_summary": (
        judge_summary,
        f"""WITH {JUDGED_SQL} SELECT count(*) AS total, count(*) FILTER (WHERE kept) AS kept,
            count(*) FILTER (WHERE discard_reason = 'position_bias_disagreement') AS position_bias_disagreement,
            count(*) FILTER (WHERE discard_reason = 'parse_failure') AS parse_failure,
            count(*) FILTER (WHERE discard_reason = 'api_failure') AS api_failure,
            count(*) FILTER (WHERE discard_reason = 'degenerate_pair') AS degenerate_pair, 0 AS not_judged,
            round(avg(length_ratio), 6) AS mean_length_ratio FROM judged""",
    ),
    "judge_bias": (
        judge_bias,
        f"""WITH {JUDGED_SQL}, both_orders AS (SELECT f, s, (f <> s)::INT AS agree FROM judged WHERE early IS NULL)
        SELECT 'forward' AS "order", round(avg((f = 'A')::INT), 6) AS a_rate, round(avg(agree), 6) AS agreement FROM both_orders
        UNION ALL
        SELECT 'swapped', round(avg((s = 'A')::INT), 6), round(avg(agree), 6) FROM both_orders""",
    ),
    "resume_todo": (resume_todo, f"WITH {RAW_PAIRS_SQL} SELECT key FROM raw_pairs WHERE key % 3 <> 0"),
    "preference_set": (
        preference_set,
        f"""WITH {JUDGED_SQL},
        coded AS (SELECT key, {_WRAPPED} AS wrapped, chosen, rejected, {byte_ids(_WRAPPED)} AS p,
            {_ENDED['chosen']} AS c, {_ENDED['rejected']} AS r FROM judged WHERE kept),
        joined AS (SELECT *, list_concat(p, c) AS pc, list_concat(p, r) AS pr,
            list_concat(list_transform(p, lambda x: 0), list_transform(c, lambda x: 1)) AS cm,
            list_concat(list_transform(p, lambda x: 0), list_transform(r, lambda x: 1)) AS rm FROM coded)
        SELECT key, wrapped AS prompt, chosen, rejected, len(p) AS n_prompt,
            md5(array_to_string({fitted('pc', MAX_LENGTH, 1)}, ',')) AS chosen_md5,
            md5(array_to_string({fitted('pr', MAX_LENGTH, 1)}, ',')) AS rejected_md5,
            md5(array_to_string({fitted('cm', MAX_LENGTH, 0)}, ',')) AS chosen_mask_md5,
            md5(array_to_string({fitted('rm', MAX_LENGTH, 0)}, ',')) AS rejected_mask_md5
        FROM joined""",
    ),
    "preference_metrics": (
        metrics,
        f"""WITH r AS (
            SELECT l_returnflag, {DPO_BETA} * (-l_extendedprice / 1000 + l_extendedprice / 1000 * (1 - l_discount)) AS c,
                {DPO_BETA} * (-l_quantity * 2 + l_quantity * (2 - l_tax)) AS x FROM lineitem
        )
        SELECT l_returnflag, count(*) AS n_pairs, round(avg((c > x)::INT), 6) AS accuracy,
            round(avg(c - x), 6) AS margin, round(avg(ln(1 + exp(-(c - x)))), 6) AS loss
        FROM r GROUP BY l_returnflag""",
    ),
    "jsonl_recovery": (
        jsonl_recovery,
        f"""WITH {RAW_PAIRS_SQL} SELECT CASE WHEN key % 10 IN (1, 2) THEN 'malformed_line'
            WHEN key % 10 = 4 THEN 'missing completion_b' ELSE 'good' END AS reason, count(*) AS n
        FROM raw_pairs WHERE key % 10 <> 5 GROUP BY 1""",
    ),
}
