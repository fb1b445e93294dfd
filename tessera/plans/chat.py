"""Queries over conversations and request logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixed_values import DEFAULT_MAX_NEW_TOKENS, IGNORE_INDEX, MAX_MESSAGES, MAX_SEQ_LEN
from tessera.functions.chat import build_prompt, format_prompt, format_turn
from tessera.functions.sequences import ids_digest, target_count
from tessera.operators.conversations import (
    asked_turns,
    assemble,
    chat_prompts,
    fit_context,
    flatten_messages,
    heads,
    messages_error,
    validate_conversations,
)
from tessera.operators.budget import corpus_report
from tessera.operators.examples import chat_examples
from tessera.operators.replies import assemble_replies
from tessera.operators.requests import prompt_token_counts, request_outcomes
from tessera.operators.vocabulary import Vocabulary
from tessera.operators.ordering import with_batches
from tessera.plans.sql import byte_ids, fitted, prompt_markup, seeded, turn_markup
from tessera.plans.tables import (
    request_log,
    response_chunks,
    table,
)
from tessera.session import scratch_path
from tessera.sources.corpora import CORPORA, load_corpus

CONTEXT = 1200
CHAT_BATCH = 8


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations")


def sft_examples(spark: SparkSession, folder: str) -> DataFrame:
    examples = chat_examples(_turns(spark, folder))
    supervised = F.size(F.filter("labels", lambda x: x != IGNORE_INDEX))
    return examples.select(
        "conv_id",
        "kept_ids",
        supervised.alias("n_supervised"),
        (MAX_SEQ_LEN - F.col("kept_ids")).alias("n_pad"),
        "truncated",
        ids_digest(F.col("input_ids")).alias("ids_md5"),
        ids_digest(F.col("labels")).alias("labels_md5"),
    )


def chat_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Chat examples put into full batches."""
    turns = _turns(spark, folder)
    # Places need the keys alone; the examples are encoded once and join them.
    batched = with_batches(turns.select("conv_id").distinct(), "conv_id", CHAT_BATCH)
    return batched.join(chat_examples(turns).select("conv_id", "kept_ids"), "conv_id").select(
        "conv_id", "batch_no", "slot", "kept_ids"
    )


def shift_targets(spark: SparkSession, folder: str) -> DataFrame:
    return chat_examples(_turns(spark, folder), max_seq_len=1024).select(
        "conv_id", target_count(F.col("labels")).alias("n_targets")
    )


def chat_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """A named chat corpus with a validation split of its own, from message lists in files to its token budget."""
    spec, root = CORPORA["smoltalk"], scratch_path(spark, "corpora")
    talks = assemble(_turns(spark, folder)).select("conv_id", F.col("messages").alias(spec.messages_column))
    own = F.col("conv_id") % 4 == 0
    talks.where(~own).write.parquet(spec.location(root, spec.split))
    talks.where(own).write.parquet(spec.location(root, spec.val_split))
    train, val = load_corpus(spark, spec, root, "conv_id")
    both = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    examples = chat_examples(flatten_messages(both)).join(both.select("conv_id", "split"), "conv_id")
    counted = examples.withColumn("n_targets", target_count(F.col("labels")))
    return corpus_report(counted, ["split"], "kept_ids", batch_size=4, accumulation=2).drop("raw_tokens", "truncated")


def turn_markups(spark: SparkSession, folder: str) -> DataFrame:
    role, text = F.col("role"), F.col("text")
    return _turns(spark, folder).select(
        "conv_id",
        "turn",
        format_turn(role, text).alias("turn_text"),
        build_prompt(text, role == "user").alias("prompt"),
        format_prompt(text).alias("as_question"),
    )


def chat_prompt(spark: SparkSession, folder: str) -> DataFrame:
    return chat_prompts(_turns(spark, folder))


def round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Turns gathered into message arrays and spread out again."""
    return flatten_messages(assemble(_turns(spark, folder)))


def validated(spark: SparkSession, folder: str) -> DataFrame:
    return validate_conversations(_turns(spark, folder)).drop("messages")


def fitted_context(spark: SparkSession, folder: str) -> DataFrame:
    asked = heads(asked_turns(_turns(spark, folder)), MAX_MESSAGES + 1)
    valid = asked.where(messages_error(F.col("messages"), F.col("n_messages")).isNull())
    counts = prompt_token_counts(F.col("messages"), Vocabulary(), spark)
    fit = fit_context(F.col("messages"), counts, F.lit(DEFAULT_MAX_NEW_TOKENS), CONTEXT)
    return valid.withColumn("_fit", fit).select(
        "conv_id",
        (F.size("messages") - F.col("_fit.first")).alias("kept_turns"),
        F.col("_fit.used").alias("used_tokens"),
        F.when(F.col("_fit").isNull(), F.lit("context_too_long")).alias("error_code"),
    )


def request_results(spark: SparkSession, folder: str) -> DataFrame:
    return request_outcomes(request_log(spark, folder), max_seq_len=CONTEXT)


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return request_results(spark, folder).select(
        "request_id", "max_new_tokens", "temperature", "top_p", "top_k", "repetition_penalty", "outcome",
        "error", "kept_turns", "used_tokens", F.md5("prompt").alias("prompt_md5"),
    )


def outcome_counts(spark: SparkSession, folder: str) -> DataFrame:
    return request_results(spark, folder).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def replies(spark: SparkSession, folder: str) -> DataFrame:
    return assemble_replies(response_chunks(spark, folder)).select("request_id", "reply", "status")


_EXAMPLES = f"""
    t AS (SELECT conv_id, turn, role, {byte_ids(turn_markup())} AS ids FROM conversations),
    u AS (SELECT conv_id, turn, role,
        CASE WHEN role = 'assistant' THEN list_append(ids, 1) ELSE ids END AS ids FROM t),
    v AS (SELECT conv_id, flatten(list(ids ORDER BY turn)) AS ids,
        flatten(list(CASE WHEN role = 'assistant' THEN ids ELSE list_transform(ids, lambda x: {IGNORE_INDEX}) END
            ORDER BY turn)) AS labels
        FROM u GROUP BY conv_id)
"""


def _rule(code: str, text: str) -> str:
    return f"struct_pack(code := {code}, text := {text})"


_CHECKED = f"""
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM {{source}}
    ),
    expected AS (SELECT *, CASE WHEN i % 2 = 0 THEN 'user' ELSE 'assistant' END AS want FROM numbered),
    broken AS (
        SELECT conv_id, i, text, role, CASE
            WHEN role NOT IN ('user', 'assistant') THEN
                {_rule("'invalid_role'", "'message ' || i || ' has invalid role ''' || role || '''; must be ''user'' or ''assistant'''")}
            WHEN text = '' THEN {_rule("'empty_content'", "'message ' || i || ' must have non-empty string ''content'''")}
            WHEN length(text) > 8000 THEN
                {_rule("'content_too_long'", "'message ' || i || ' content is ' || length(text) || ' chars, exceeds limit of 8000'")}
            WHEN role <> want THEN
                {_rule("'wrong_turn'", "'messages must alternate starting with ''user''; message ' || i || ' has role ''' || role || ''', expected ''' || want || ''''")}
            END AS e
        FROM expected
    ),
    checked AS (
        SELECT conv_id, count(*) AS n_messages, CASE
            WHEN count(*) > 50 THEN {_rule("'too_many_messages'", "'messages has ' || count(*) || ' entries, exceeds limit of 50'")}
            WHEN count(e) > 0 THEN arg_min(e, i) FILTER (WHERE e IS NOT NULL)
            WHEN arg_max(role, i) <> 'user' THEN {_rule("'ends_on_assistant'", "'messages must end on a ''user'' turn'")}
            END AS e
        FROM broken GROUP BY conv_id
    )
"""
_ASKED = """
    asked AS (
        SELECT c.* FROM conversations c
        JOIN (SELECT conv_id, max(turn) FILTER (WHERE role = 'user') AS last FROM conversations GROUP BY conv_id) l
        ON c.conv_id = l.conv_id AND c.turn <= l.last
        WHERE role <> 'system'
    )
"""
_FIT = f"""
    sized AS (
        SELECT conv_id, i, octet_length(encode({turn_markup()})) AS n,
            count(*) OVER (PARTITION BY conv_id) AS n_turns,
            sum(octet_length(encode({turn_markup()}))) OVER (PARTITION BY conv_id ORDER BY i DESC) AS rest
        FROM numbered
    ),
    cuts AS (
        SELECT s.conv_id, i, n_turns, rest + 14 AS used FROM sized s WHERE i % 2 = 0
    )
"""

_OUTCOMES = f"""
    params(m, new_tokens, t, p, k, r, bad) AS (VALUES
        (0, 50, 1.0, 1.0, 0, 1.0, NULL),
        (1, 7777, 1.0, 1.0, 0, 1.0, NULL),
        (2, 50, -0.5, 1.0, 0, 1.0, NULL),
        (3, 50, 0.004, 1.0, 0, 1.0, NULL),
        (4, 50, 3.5, 1.25, 0, 1.0, NULL),
        (5, 50, 1.0, 0.0, -2, 1.0, NULL),
        (6, 50, 1.0, 1.0, 0, 6.0, NULL),
        (7, 50, 1.0, 1.0, 33, 0.25, NULL),
        (8, NULL, 1.0, 1.0, 0, 1.0, 'invalid literal for int() with base 10: ''many'''),
        (9, 50, NULL, 1.0, 0, 1.0, 'float() argument must be a string or a real number, not ''NoneType'''),
        (10, 64, 0.5, 1.0, 0, 1.0, NULL),
        (11, 10, 1.0, 0.5, 0, 1.0, NULL)
    ),
    {_ASKED},
    kept AS (
        SELECT * FROM conversations WHERE conv_id % 7 = 3 AND conv_id % 29 <> 5
        UNION ALL SELECT * FROM asked WHERE conv_id % 7 <> 3 AND conv_id % 29 <> 5
    ),
    {_CHECKED.format(source='kept')},
    {_FIT},
    everyone AS (
        SELECT DISTINCT conv_id, CASE WHEN conv_id % 29 = 5 THEN 0 ELSE conv_id % 12 END AS m FROM conversations
    ),
    clamped AS (
        SELECT conv_id, bad, least(new_tokens, 512) AS max_new_tokens,
            CASE WHEN t <= 0 THEN 0 ELSE greatest(0.01, least(t, 2.0)) END AS temperature,
            CASE WHEN p <= 0 THEN 1 ELSE least(p, 1.0) END AS top_p,
            greatest(k, 0) AS top_k, greatest(1.0, least(r, 2.0)) AS repetition_penalty
        FROM everyone JOIN params USING (m)
    ),
    fits AS (
        SELECT c.conv_id, min(i) AS first FROM cuts c JOIN clamped q ON q.conv_id = c.conv_id
        WHERE used + max_new_tokens <= {CONTEXT} GROUP BY c.conv_id
    ),
    prompts AS (
        SELECT n.conv_id, count(*) AS kept_turns, sum(octet_length(encode({turn_markup()}))) + 14 AS used,
            string_agg({turn_markup()}, '' ORDER BY n.i) || '<|assistant|>' || chr(10) AS prompt
        FROM numbered n JOIN fits f ON f.conv_id = n.conv_id AND n.i >= f.first GROUP BY n.conv_id
    ),
    outcomes AS (
        SELECT q.conv_id AS request_id, max_new_tokens::BIGINT AS max_new_tokens, temperature::DOUBLE AS temperature,
            top_p::DOUBLE AS top_p, top_k::BIGINT AS top_k, repetition_penalty::DOUBLE AS repetition_penalty,
            CASE WHEN bad IS NOT NULL THEN 'invalid_parameter'
                 WHEN c.conv_id IS NULL THEN 'no_messages'
                 WHEN c.e IS NOT NULL THEN c.e.code
                 WHEN p.conv_id IS NULL THEN 'context_too_long' ELSE 'accepted' END AS outcome,
            CASE WHEN bad IS NOT NULL THEN bad
                 WHEN c.conv_id IS NULL THEN 'messages must be a non-empty list'
                 WHEN c.e IS NOT NULL THEN c.e.text
                 WHEN p.conv_id IS NULL THEN 'prompt exceeds max_seq_len even after truncating all prior turns'
                 END AS error,
            p.kept_turns, p.used, p.prompt
        FROM clamped q LEFT JOIN checked c ON c.conv_id = q.conv_id LEFT JOIN prompts p ON p.conv_id = q.conv_id
    )
"""

QUERIES = {
    "sft_examples": (
        sft_examples,
        f"""WITH {_EXAMPLES}
        SELECT conv_id, least(len(ids), {MAX_SEQ_LEN}) AS kept_ids,
            len(list_filter(labels[1:{MAX_SEQ_LEN}], lambda x: x <> {IGNORE_INDEX})) AS n_supervised,
            {MAX_SEQ_LEN} - least(len(ids), {MAX_SEQ_LEN}) AS n_pad, len(ids) > {MAX_SEQ_LEN} AS truncated,
            md5(array_to_string({fitted('ids', MAX_SEQ_LEN, 1)}, ',')) AS ids_md5,
            md5(array_to_string({fitted('labels', MAX_SEQ_LEN, IGNORE_INDEX)}, ',')) AS labels_md5
        FROM v""",
    ),
    "chat_batches": (
        chat_batches,
        f"""WITH {_EXAMPLES},
        p AS (SELECT conv_id, len(ids) AS n, row_number() OVER (ORDER BY {seeded('conv_id')}, conv_id) - 1 AS pos FROM v)
        SELECT conv_id, pos // {CHAT_BATCH} AS batch_no, pos % {CHAT_BATCH} AS slot, least(n, {MAX_SEQ_LEN}) AS kept_ids
        FROM p WHERE pos // {CHAT_BATCH} < (SELECT count(*) FROM v) // {CHAT_BATCH}""",
    ),
    "chat_corpus": (
        chat_corpus,
        f"""WITH {_EXAMPLES},
        k AS (SELECT CASE WHEN conv_id % 4 = 0 THEN 'val' ELSE 'train' END AS split, least(len(ids), {MAX_SEQ_LEN}) AS k,
            len(list_filter(labels[2:{MAX_SEQ_LEN}], lambda x: x <> {IGNORE_INDEX})) AS n_targets FROM v)
        SELECT split, count(*) AS n_docs, sum(k)::BIGINT AS kept_tokens, sum({MAX_SEQ_LEN} - k)::BIGINT AS pad_tokens,
            sum(n_targets)::BIGINT AS targets, count(*) // 4 AS n_batches, count(*) // 8 AS n_steps,
            (count(*) // 8) * {8 * MAX_SEQ_LEN} AS step_tokens
        FROM k GROUP BY split""",
    ),
    "shift_targets": (
        shift_targets,
        f"""WITH {_EXAMPLES}
        SELECT conv_id, len(list_filter(labels[2:1024], lambda x: x <> {IGNORE_INDEX})) AS n_targets FROM v""",
    ),
    "turn_markup": (
        turn_markups,
        f"""SELECT conv_id, turn, {turn_markup()} AS turn_text,
            CASE WHEN role = 'user' THEN {prompt_markup('text')} ELSE text END AS prompt,
            {prompt_markup('text')} AS as_question FROM conversations""",
    ),
    "chat_prompt": (
        chat_prompt,
        f"""SELECT conv_id, string_agg({turn_markup()}, '' ORDER BY turn) || '<|assistant|>' || chr(10) AS prompt
        FROM conversations GROUP BY conv_id""",
    ),
    "conversation_round_trip": (round_trip, "SELECT conv_id, turn, role, text FROM conversations"),
    "validate_conversations": (
        validated,
        f"""WITH {_CHECKED.format(source='conversations')}
        SELECT conv_id, n_messages, e.code AS error_code, e.text AS error FROM checked""",
    ),
    "fit_context": (
        fitted_context,
        f"""WITH {_ASKED}, {_CHECKED.format(source='asked')}, {_FIT},
        good AS (SELECT conv_id FROM checked WHERE e IS NULL),
        fits AS (SELECT conv_id, min(i) AS first FROM cuts WHERE used + {DEFAULT_MAX_NEW_TOKENS} <= {CONTEXT} GROUP BY conv_id)
        SELECT g.conv_id, c.n_turns - c.i AS kept_turns, c.used::BIGINT AS used_tokens,
            CASE WHEN f.conv_id IS NULL THEN 'context_too_long' END AS error_code
        FROM good g LEFT JOIN fits f ON f.conv_id = g.conv_id
            LEFT JOIN cuts c ON c.conv_id = f.conv_id AND c.i = f.first""",
    ),
    "request_outcomes": (
        outcomes,
        f"""WITH {_OUTCOMES}
        SELECT request_id, max_new_tokens, temperature, top_p, top_k, repetition_penalty, outcome, error,
            CASE WHEN outcome = 'accepted' THEN kept_turns END AS kept_turns,
            CASE WHEN outcome = 'accepted' THEN used::BIGINT END AS used_tokens,
            CASE WHEN outcome = 'accepted' THEN md5(prompt) END AS prompt_md5
        FROM outcomes""",
    ),
    "outcome_counts": (
        outcome_counts,
        f"WITH {_OUTCOMES} SELECT outcome, count(*) AS n FROM outcomes GROUP BY outcome",
    ),
    "replies": (
        replies,
        """WITH turns AS (SELECT conv_id * 1000 + turn AS request_id, string_split(text, ' ') AS words FROM conversations),
        tokens AS (
            SELECT request_id, i - 1 AS seq, CASE WHEN i > 1 THEN ' ' || words[i] ELSE words[i] END AS token
            FROM turns, unnest(range(1, len(words) + 1)) AS u(i)
        ),
        joined AS (SELECT request_id, string_agg(token, '' ORDER BY seq) AS reply FROM tokens GROUP BY request_id)
        SELECT t.request_id, coalesce(reply, '') AS reply,
            CASE WHEN t.request_id % 5 = 0 THEN 'error' WHEN t.request_id % 5 = 1 THEN 'incomplete' ELSE 'ok' END AS status
        FROM turns t LEFT JOIN joined j ON j.request_id = t.request_id""",
    ),
}
