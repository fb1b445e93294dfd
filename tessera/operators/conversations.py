"""Long turn tables to message arrays, and checks on message arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.fixed_values import (
    ASSISTANT_OPENER,
    CONTENT_TOO_LONG_TEXT,
    EMPTY_CONTENT_TEXT,
    ENDS_ON_ASSISTANT_TEXT,
    INVALID_ROLE_TEXT,
    MAX_CONTENT_CHARS,
    MAX_MESSAGES,
    NO_MESSAGES_TEXT,
    TOO_MANY_MESSAGES_TEXT,
    WRONG_TURN_TEXT,
)
from tessera.functions.chat import format_turns
from tessera.functions.text import fill, python_repr
from tessera.operators.skew import first_rows

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


def _messages(order: str, role: str, content: str) -> Column:
    ordered = F.array_sort(
        F.collect_list(
            F.struct(
                F.col(order).alias("o"), F.col(role).alias("role"), F.col(content).alias("content")
            )
        )
    )
    return F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))


def assemble(
    turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
    content: str = "text",
) -> DataFrame:
    """(key, turns, messages): every conversation as one row, with the numbers of its turns.

    A message list is one value, so a conversation must fit a task. (key, order) must be unique.
    """
    return turns.groupBy(key).agg(
        F.array_sort(F.collect_list(order)).alias("turns"), _messages(order, role, content).alias("messages")
    )


def heads(
    turns: DataFrame, n: int, key: str = "conv_id", order: str = "turn", role: str = "role",
    content: str = "text",
) -> DataFrame:
    """(key, n_messages, messages): every conversation's length and its first ``n`` turns.

    Only the first ``n`` turns of a conversation are gathered; the length is counted map-side.
    """
    first = (
        first_rows(turns.select(key, order, role, content), [key], [order], n)
        .groupBy(key)
        .agg(_messages(order, role, content).alias("messages"))
    )
    counts = turns.groupBy(key).agg(F.count(F.lit(1)).alias("n_messages"))
    return first.join(counts, key)


def flatten_messages(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """The inverse of ``assemble``: one row per turn, with its own number. Message lists without
    ``turns`` are numbered from 0."""
    kept = ["turns"] if "turns" in conversations.columns else []
    spread = conversations.select(key, *kept, F.posexplode("messages").alias("pos", "m"))
    number = F.get(F.col("turns"), F.col("pos")) if kept else F.col("pos")
    return spread.select(key, number.cast("bigint").alias("turn"), "m.role", F.col("m.content").alias("text"))


def chat_prompts(
    turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
    content: str = "text",
) -> DataFrame:
    """(key, prompt): the chat markup of every conversation, the assistant turn opened at its end."""
    prompt = F.concat(format_turns(F.col("messages")), F.lit(ASSISTANT_OPENER))
    return assemble(turns, key, order, role, content).select(key, prompt.alias("prompt"))


def asked_turns(
    turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role"
) -> DataFrame:
    """The turns a model is asked with: those up to the last question, system turns left out.

    The last question is an aggregate, so no conversation is gathered for it."""
    last = turns.where(F.col(role) == "user").groupBy(key).agg(F.max(order).alias("_last"))
    return (
        turns.join(last, key)
        .where((F.col(order) <= F.col("_last")) & (F.col(role) != "system"))
        .drop("_last")
    )


def _error(code: str, template: str, **slots: Column) -> Column:
    return F.struct(F.lit(code).alias("code"), fill(template, **slots).alias("text"))


def _message_error(m: Column, i: Column, shown_roles: Column | None = None) -> Column:
    """(code, text) of the first rule one message breaks, NULL when it breaks none."""
    role, content = m["role"], m["content"]
    expected = F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant"))
    length = F.char_length(content)
    shown = python_repr(role) if shown_roles is None else F.get(shown_roles, i)
    return (
        F.when(
            role.isNull() | ~role.isin("user", "assistant"),
            _error("invalid_role", INVALID_ROLE_TEXT, i=i, role=shown),
        )
        .when(content.isNull() | (content == ""), _error("empty_content", EMPTY_CONTENT_TEXT, i=i))
        .when(
            length > MAX_CONTENT_CHARS,
            _error(
                "content_too_long", CONTENT_TOO_LONG_TEXT, i=i, count=length,
                limit=F.lit(MAX_CONTENT_CHARS),
            ),
        )
        .when(
            role != expected,
            _error("wrong_turn", WRONG_TURN_TEXT, i=i, role=shown, expected=python_repr(expected)),
        )
    )


def messages_error(
    messages: Column, n_messages: Column | None = None, shown_roles: Column | None = None
) -> Column:
    """struct(code, text) of the first rule a message list breaks, NULL for a good one.

    ``n_messages`` is the true length where ``messages`` holds only the leading turns.
    ``shown_roles`` is how to show each role in an error where roles need not be strings.
    """
    total = F.size(messages) if n_messages is None else n_messages
    broken = F.get(
        F.filter(
            F.transform(messages, lambda m, i: _message_error(m, i, shown_roles)),
            lambda e: e.isNotNull(),
        ),
        F.lit(0),
    )
    too_many = _error(
        "too_many_messages", TOO_MANY_MESSAGES_TEXT, count=total, limit=F.lit(MAX_MESSAGES)
    )
    return (
        F.when(messages.isNull() | (total == 0), _error("no_messages", NO_MESSAGES_TEXT))
        .when(total > MAX_MESSAGES, too_many)
        .when(broken.isNotNull(), broken)
        .when(
            F.element_at(messages, -1)["role"] != "user",
            _error("ends_on_assistant", ENDS_ON_ASSISTANT_TEXT),
        )
    )


def validate_conversations(
    turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role",
    content: str = "text",
) -> DataFrame:
    """(key, n_messages, messages, error_code, error) for every conversation; ``messages`` is NULL
    where it is rejected.

    One turn more than the limit is enough to know a conversation is too long.
    """
    checked = heads(turns, MAX_MESSAGES + 1, key, order, role, content).withColumn(
        "_e", messages_error(F.col("messages"), F.col("n_messages"))
    )
    return checked.select(
        key, "n_messages", F.when(F.col("_e").isNull(), F.col("messages")).alias("messages"), F.col("_e.code").alias("error_code"), F.col("_e.text").alias("error")
    )


def fit_context(
    messages: Column, token_counts: Column, max_new_tokens: Column, max_seq_len: int
) -> Column:
    """struct(first, used): how many leading turns to drop (always whole pairs) so that the rest,
    the opener and the reply fit; NULL when one turn alone does not fit.

    ``token_counts`` holds the count of every message and, last, that of the opener. Messages are
    at most ``MAX_MESSAGES`` after validation, so trying every cut is cheap.
    """
    n = F.size(messages)

    def used(first: Column) -> Column:
        kept = F.slice(token_counts, first + 1, n - first + 1)
        return F.aggregate(kept, F.lit(0), lambda total, x: total + x)

    tried = F.transform(
        F.sequence(F.lit(0), n, F.lit(2)),
        lambda k: F.struct(k.alias("first"), used(k).alias("used")),
    )
    return F.get(F.filter(tried, lambda t: t["used"] + max_new_tokens <= max_seq_len), F.lit(0))
