"""Inputs of the registered queries: the given tables, and data Spark derives from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.conversations import asked_turns, assemble
from tessera.operators.ordering import with_batches
from tessera.operators.scores import log_probs
from tessera.operators.skew import first_rows
from tessera.fixed_values import IGNORE_INDEX


# Rows per batch of the loss queries.
LOSS_BATCH = 32


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---- answer pairs -----------------------------------------------------------------------------

# SQL of ``raw_pairs``, as a WITH entry.
RAW_PAIRS_SQL = r"""
    turns_by_role AS (
        SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS no
        FROM conversations
    ),
    answered AS (
        SELECT conv_id AS key,
            max(text) FILTER (WHERE role = 'user' AND no = 1) AS prompt,
            max(text) FILTER (WHERE role = 'assistant' AND no = 1) AS completion_a,
            max(text) FILTER (WHERE role = 'assistant' AND no = 2) AS second
        FROM turns_by_role GROUP BY conv_id
    ),
    raw_pairs AS (
        SELECT key, prompt, completion_a,
            CASE WHEN key % 10 = 3 THEN completion_a
                 WHEN key % 10 = 7 THEN '  ' || chr(10) || chr(9)
                 ELSE coalesce(second, prompt) END AS completion_b
        FROM answered WHERE prompt IS NOT NULL AND completion_a IS NOT NULL
    )
"""


def raw_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """(key, prompt, completion_a, completion_b): a conversation's first question with its first
    and second answer. Some second answers are made equal or blank."""
    turns = table(spark, folder, "conversations").where(F.col("role").isin("user", "assistant"))
    leading = first_rows(turns, ["conv_id", "role"], ["turn"], 2)

    def text_of(role: str, number: int) -> Column:
        return F.max(F.when((F.col("role") == role) & (F.col("row_no") == number), F.col("text")))

    answered = leading.groupBy(F.col("conv_id").alias("key")).agg(
        text_of("user", 1).alias("prompt"),
        text_of("assistant", 1).alias("completion_a"),
        text_of("assistant", 2).alias("second"),
    )
    b = (
        F.when(F.col("key") % 10 == 3, F.col("completion_a"))
        .when(F.col("key") % 10 == 7, F.lit("  \n\t"))
        .otherwise(F.coalesce("second", "prompt"))
    )
    return answered.where(F.col("prompt").isNotNull() & F.col("completion_a").isNotNull()).select(
        "key", "prompt", "completion_a", b.alias("completion_b")
    )


def stub_judge():
    """A judge without a model: prefers the shorter answer, and by the prompt's length sometimes
    the first one shown, an unusable answer, or an error."""
    def judge(request: str) -> str:
        def between(tag: str) -> str:
            return request.split(f"<{tag}>\n", 1)[1].split(f"\n</{tag}>", 1)[0]

        size = len(between("prompt"))
        if size % 11 == 5:
            return "not json"
        if size % 11 == 6:
            raise RuntimeError("unreachable")
        if size % 13 == 7:
            return "[]"
        shorter = len(between("response_a")) <= len(between("response_b"))
        verdict = "A" if size % 5 == 0 or shorter else "B"
        return f'{{"reasoning": "by length", "verdict": "{verdict}"}}'

    return judge


# SQL of the judged pairs under ``stub_judge``, as WITH entries.
JUDGED_SQL = RAW_PAIRS_SQL + r"""
    , sized AS (
        SELECT *, length(prompt) AS size, length(completion_a) AS na, length(completion_b) AS nb,
            completion_a = completion_b OR regexp_full_match(completion_a, '\s*')
                OR regexp_full_match(completion_b, '\s*') AS degenerate
        FROM raw_pairs
    ),
    verdicts AS (
        SELECT *,
            CASE WHEN degenerate THEN 'degenerate_pair'
                 WHEN size % 11 = 5 THEN 'parse_failure'
                 WHEN size % 11 = 6 OR size % 13 = 7 THEN 'api_failure' END AS early,
            CASE WHEN size % 5 = 0 OR na <= nb THEN 'A' ELSE 'B' END AS f,
            CASE WHEN size % 5 = 0 OR nb <= na THEN 'A' ELSE 'B' END AS s
        FROM sized
    ),
    reasons AS (
        SELECT *, coalesce(early, CASE WHEN f = s THEN 'position_bias_disagreement' END) AS discard_reason
        FROM verdicts
    ),
    judged AS (
        SELECT key, prompt, completion_a, completion_b, discard_reason, early, f, s,
            discard_reason IS NULL AS kept,
            CASE WHEN discard_reason IS NULL THEN CASE WHEN f = 'A' THEN completion_a ELSE completion_b END END AS chosen,
            CASE WHEN discard_reason IS NULL THEN CASE WHEN f = 'A' THEN completion_b ELSE completion_a END END AS rejected,
            CASE WHEN discard_reason IS NULL THEN CASE WHEN f = 'A' THEN na / greatest(nb, 1) ELSE nb / greatest(na, 1) END END AS length_ratio
        FROM reasons
    )
"""


# ---- request log ------------------------------------------------------------------------------

# Parameter text of a request, by conv_id % 12.
REQUEST_PARAMETERS = (
    "",
    ', "max_new_tokens": 7777',
    ', "temperature": -0.5',
    ', "temperature": 0.004',
    ', "temperature": 3.5, "top_p": 1.25',
    ', "top_p": 0, "top_k": -2',
    ', "repetition_penalty": 6',
    ', "repetition_penalty": 0.25, "top_k": 33',
    ', "max_new_tokens": "many"',
    ', "temperature": null',
    ', "max_new_tokens": " 64 ", "temperature": "0.5"',
    ', "max_new_tokens": 10.7, "top_p": 0.5',
)


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """(request_id, payload): one JSON request per conversation; every seventh keeps its turns as
    they are, and some have no object as input."""
    turns = table(spark, folder, "conversations")
    whole = assemble(turns).join(
        assemble(asked_turns(turns)).select("conv_id", F.col("messages").alias("asked")), "conv_id", "left"
    )
    key = F.col("conv_id")
    messages = F.coalesce(
        F.to_json(F.when(key % 7 == 3, F.col("messages")).otherwise(F.col("asked"))), F.lit("[]")
    )
    parameters = F.element_at(F.array(*map(F.lit, REQUEST_PARAMETERS)), (key % 12 + 1).cast("int"))
    body = F.when(key % 29 == 5, F.lit('"not a dict"')).otherwise(
        F.concat(F.lit('{"messages": '), messages, parameters, F.lit("}"))
    )
    return whole.select(
        key.alias("request_id"), F.concat(F.lit('{"input": '), body, F.lit("}")).alias("payload")
    )


# ---- response chunks --------------------------------------------------------------------------


def response_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """(request_id, seq, token, done, error): the words of every turn as streamed tokens, then a
    closing chunk, which is an error for some and missing for others."""
    turns = table(spark, folder, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"), F.split("text", " ").alias("words")
    )
    token = F.when(F.col("seq") > 0, F.concat(F.lit(" "), F.col("word"))).otherwise(F.col("word"))
    none = F.lit(None).cast("string")
    words = turns.select("request_id", F.posexplode("words").alias("seq", "word")).select(
        "request_id", F.col("seq").cast("bigint").alias("seq"), token.alias("token"),
        F.lit(False).alias("done"), none.alias("error"),
    )
    kind = F.col("request_id") % 5
    closing = turns.where(kind != 1).select(
        "request_id", F.size("words").cast("bigint").alias("seq"), none.alias("token"),
        F.lit(True).alias("done"), F.when(kind == 0, F.lit("boom")).alias("error"),
    )
    return words.unionByName(closing)


# ---- score table ------------------------------------------------------------------------------

SCORES_SQL = """
    scores AS (
        SELECT vec_id AS row_id, i - 1 AS token_id, embedding[i]::DOUBLE * 10 AS logit
        FROM embeddings, unnest(range(1, len(embedding) + 1)) AS u(i)
    )
"""
TARGETS_SQL = SCORES_SQL + f"""
    , log_probs AS (
        SELECT row_id, token_id, logit - top - ln(sum(exp(logit - top)) OVER (PARTITION BY row_id)) AS log_prob
        FROM (SELECT *, max(logit) OVER (PARTITION BY row_id) AS top FROM scores)
    ),
    targets AS (
        SELECT e.vec_id, e.vec_id // 8 AS example, e.vec_id % 8 AS position,
            CASE WHEN e.vec_id % 5 = 0 THEN {IGNORE_INDEX} ELSE e.label END AS label, p.log_prob
        FROM embeddings e JOIN log_probs p ON p.row_id = e.vec_id AND p.token_id = e.label
    )
"""


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """(row_id, token_id, logit): the entries of every embedding, scaled."""
    return (
        table(spark, folder, "embeddings")
        .select(F.col("vec_id").alias("row_id"), F.posexplode("embedding").alias("token_id", "logit"))
        .withColumn("logit", F.col("logit").cast("double") * 10)
    )


def seen_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """(row_id, token_id) of tokens generated before, some of them twice."""
    hits = scores(spark, folder).where((F.col("row_id") + F.col("token_id")) % 7 == 0)
    return hits.select("row_id", "token_id").withColumn(
        "_twice", F.explode(F.sequence(F.lit(0), (F.col("token_id") % 2).cast("int")))
    ).drop("_twice")


def dense_scores(spark: SparkSession, folder: str) -> DataFrame:
    """(row_id, logits): the same scores as one vector per row."""
    logits = F.transform("embedding", lambda x: x.cast("double") * 10)
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("row_id"), logits.alias("logits"))


def loss_targets(spark: SparkSession, folder: str, batched: bool = False) -> DataFrame:
    """(example, position, label, log_prob): the score of each row's label. ``batched`` puts rows
    into full batches of ``LOSS_BATCH`` and adds ``batch_no``."""
    rows = table(spark, folder, "embeddings").select("vec_id", "label")
    batch = []
    if batched:
        rows, batch = with_batches(rows, "vec_id", LOSS_BATCH), ["batch_no"]
    row = F.col("vec_id")
    labels = rows.select(
        row.alias("row_id"), F.col("label").alias("token_id"), F.floor(row / 8).alias("example"),
        (row % 8).alias("position"),
        F.when(row % 5 == 0, F.lit(IGNORE_INDEX)).otherwise(F.col("label")).alias("label"), *batch,
    )
    return log_probs(scores(spark, folder)).join(labels, ["row_id", "token_id"]).select(
        "example", "position", "label", "log_prob", *batch
    )


# ---- run log ----------------------------------------------------------------------------------

RUN_LOG_SQL = """
    run_log AS (
        SELECT user_id AS run, event_id AS step,
            CASE WHEN event_type NOT IN ('click', 'error') THEN value END AS val_loss,
            CASE WHEN event_type = 'error' THEN 'saved checkpoint at step ' || event_id ELSE event_type END AS message
        FROM events
    )
"""


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """(run, step, val_loss, message): one run per user, its steps being event ids."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("step"),
        F.when(~kind.isin("click", "error"), F.col("value")).alias("val_loss"),
        F.when(
            kind == "error", F.concat(F.lit("saved checkpoint at step "), F.col("event_id").cast("string"))
        ).otherwise(kind).alias("message"),
    )


def log_prob_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Per line item, four log-probabilities by fixed arithmetic."""
    return table(spark, folder, "lineitem").select(
        "l_returnflag",
        (-F.col("l_extendedprice") / 1000).alias("policy_chosen"),
        (-F.col("l_quantity") * 2).alias("policy_rejected"),
        (-F.col("l_extendedprice") / 1000 * (1 - F.col("l_discount"))).alias("ref_chosen"),
        (-F.col("l_quantity") * (2 - F.col("l_tax"))).alias("ref_rejected"),
    )
