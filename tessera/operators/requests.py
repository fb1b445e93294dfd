"""Request payloads: typed parameters with defaults and clamps, and the outcome of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixed_values import (
    ASSISTANT_OPENER,
    CONTEXT_TOO_LONG_TEXT,
    DEFAULT_MAX_NEW_TOKENS,
    DEFAULT_REPETITION_PENALTY,
    DEFAULT_TEMPERATURE,
    DEFAULT_TOP_K,
    DEFAULT_TOP_P,
    FLOAT_TYPE_TEXT,
    INT_TYPE_TEXT,
    MAX_NEW_TOKENS_CEILING,
    MAX_REPETITION_PENALTY,
    MAX_SEQ_LEN,
    MAX_TEMPERATURE,
    MIN_POSITIVE_TEMPERATURE,
    NOT_A_FLOAT_TEXT,
    NOT_AN_INT_TEXT,
    TURN_START,
)
from tessera.functions.chat import format_history, format_turn
from tessera.functions.text import fill, python_repr
from tessera.operators.conversations import fit_context, messages_error
from tessera.operators.encoding import token_counts
from tessera.operators.vocabulary import Vocabulary

_INT_TEXT = r"^\s*[+-]?\d+(_\d+)*\s*$"
_FLOAT_TEXT = (
    r"(?i)^\s*[+-]?(nan|inf(inity)?|(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?)\s*$"
)


def request_input(payload: Column) -> Column:
    """The ``input`` object of a payload; anything else there counts as an empty object."""
    body = F.try_variant_get(F.try_parse_json(payload), "$.input", "variant")
    is_object = F.startswith(F.schema_of_variant(body), F.lit("OBJECT"))
    return F.when(is_object, body).otherwise(F.parse_json(F.lit("{}")))


def _number(body: Column, name: str, default: float, whole: bool) -> Column:
    """struct(value, error) of one parameter, read as Python's int() or float() would."""
    raw = F.try_variant_get(body, f"$.{name}", "variant")
    kind = F.schema_of_variant(raw)
    text = F.try_variant_get(raw, "$", "string")
    target = "bigint" if whole else "double"
    shape = _INT_TEXT if whole else _FLOAT_TEXT
    digits = F.replace(F.regexp_replace(text, r"^\s+|\s+$", ""), F.lit("_"), F.lit(""))
    parsed = digits.try_cast(target)
    if whole:  # an integer has no largest value; what 64 bits cannot hold becomes their end
        end = F.when(F.startswith(digits, F.lit("-")), F.lit(-(1 << 63))).otherwise(F.lit((1 << 63) - 1))
        parsed = F.coalesce(parsed, end)
    from_text = F.when(F.rlike(text, F.lit(shape)), parsed)
    number = F.try_variant_get(raw, "$", "double")
    from_number = F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)) if whole else number
    exact = F.try_variant_get(raw, "$", "bigint")
    from_number = F.when(kind == "BIGINT", exact).otherwise(from_number) if whole else from_number
    value = (
        F.when(kind.isNull(), F.lit(default))
        .when(kind == "STRING", from_text)
        .when(kind == "BOOLEAN", F.try_variant_get(raw, "$", "boolean").cast("int"))
        .when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), from_number)
        .cast(target)
    )
    python_type = (
        F.when(kind == "VOID", F.lit("NoneType"))
        .when(F.startswith(kind, F.lit("ARRAY")), F.lit("list"))
        .otherwise(F.lit("dict"))
    )
    wrong_text, wrong_type = (
        (NOT_AN_INT_TEXT, INT_TYPE_TEXT) if whole else (NOT_A_FLOAT_TEXT, FLOAT_TYPE_TEXT)
    )
    error = F.when(
        value.isNull(),
        F.when(kind == "STRING", fill(wrong_text, value=python_repr(text))).otherwise(
            fill(wrong_type, type=python_type)
        ),
    )
    return F.struct(value.alias("value"), error.alias("error"))


def generation_config(body: Column) -> Column:
    """struct(max_new_tokens, temperature, top_p, top_k, repetition_penalty, error).

    Clamps spell out NaN, which Spark orders above every number and Python above none.
    """
    new_tokens = _number(body, "max_new_tokens", DEFAULT_MAX_NEW_TOKENS, whole=True)
    temperature = _number(body, "temperature", DEFAULT_TEMPERATURE, whole=False)
    top_p = _number(body, "top_p", DEFAULT_TOP_P, whole=False)
    top_k = _number(body, "top_k", DEFAULT_TOP_K, whole=True)
    penalty = _number(body, "repetition_penalty", DEFAULT_REPETITION_PENALTY, whole=False)
    t, p, r = temperature["value"], top_p["value"], penalty["value"]
    low = F.lit(MIN_POSITIVE_TEMPERATURE)
    return F.struct(
        F.least(new_tokens["value"], F.lit(MAX_NEW_TOKENS_CEILING)).alias("max_new_tokens"),
        F.when(F.isnan(t), low)
        .when(t <= 0, F.lit(0.0))
        .otherwise(F.greatest(low, F.least(t, F.lit(MAX_TEMPERATURE))))
        .alias("temperature"),
        F.when(F.isnan(p), p)
        .when(p <= 0, F.lit(1.0))
        .otherwise(F.least(p, F.lit(1.0)))
        .alias("top_p"),
        F.greatest(top_k["value"], F.lit(0)).alias("top_k"),
        F.when(F.isnan(r), F.lit(1.0))
        .otherwise(F.greatest(F.lit(1.0), F.least(r, F.lit(MAX_REPETITION_PENALTY))))
        .alias("repetition_penalty"),
        F.coalesce(*(x["error"] for x in (new_tokens, temperature, top_p, top_k, penalty))).alias(
            "error"
        ),
    )


def request_messages(body: Column) -> Column:
    """The message list, NULL unless it is one; roles and contents that are not strings are NULL."""
    def string_of(m: Column, name: str) -> Column:
        value = F.try_variant_get(m, f"$.{name}", "variant")
        text = F.try_variant_get(value, "$", "string")
        return F.when(F.schema_of_variant(value) == "STRING", text)

    return F.transform(
        F.try_variant_get(body, "$.messages", "array<variant>"),
        lambda m: F.struct(string_of(m, "role").alias("role"), string_of(m, "content").alias("content")),
    )


def shown_roles(body: Column) -> Column:
    """The role of every message as an error shows it, whatever its type."""
    def shown(m: Column) -> Column:
        role = F.try_variant_get(m, "$.role", "variant")
        kind = F.schema_of_variant(role)
        text = F.try_variant_get(role, "$", "string")
        return (
            F.when(role.isNull() | (kind == "VOID"), F.lit("None"))
            .when(kind == "STRING", python_repr(text))
            .when(kind == "BOOLEAN", F.initcap(text))
            .otherwise(F.coalesce(text, F.to_json(role)))
        )

    return F.transform(F.try_variant_get(body, "$.messages", "array<variant>"), shown)


def prompt_token_counts(messages: Column, vocab: Vocabulary, spark: SparkSession) -> Column:
    """Token counts of every turn as part of a prompt and, last, of the opener.

    White space at the end of a turn splits differently before the next turn's markup than at the
    end of a text. So each turn is counted with that markup's start behind it, whose own tokens are
    then taken off; the counts add up to those of the whole prompt.
    """
    start, opener = F.lit(TURN_START), F.lit(ASSISTANT_OPENER)
    texts = F.transform(messages, lambda m: F.concat(format_turn(m["role"], m["content"]), start))
    counts = token_counts(F.concat(texts, F.array(opener, start)), vocab, spark)
    return F.get(
        F.transform(
            F.array(counts),
            lambda c: F.array_append(
                F.transform(F.slice(c, 1, F.size(c) - 2), lambda n: n - F.element_at(c, -1)),
                F.element_at(c, -2),
            ),
        ),
        F.lit(0),
    )


def request_outcomes(
    log: DataFrame, vocab: Vocabulary | None = None, payload: str = "payload",
    max_seq_len: int = MAX_SEQ_LEN,
) -> DataFrame:
    """What becomes of every logged request: parameters, ``outcome``, ``error``, and for accepted
    ones ``kept_turns``, ``used_tokens`` and ``prompt``.

    Parameter errors come before message errors, and those before the context check. Only valid
    requests reach the token counts.
    """
    vocab = vocab or Vocabulary()
    spark: SparkSession = log.sparkSession
    parsed = log.withColumn("_body", request_input(F.col(payload)))
    parsed = parsed.withColumn("_config", generation_config(F.col("_body"))).withColumn(
        "_messages", request_messages(F.col("_body"))
    )
    checked = parsed.withColumn(
        "_bad", messages_error(F.col("_messages"), shown_roles=shown_roles(F.col("_body")))
    )
    usable = F.col("_config.error").isNull() & F.col("_bad").isNull()
    good = F.when(usable, F.col("_messages"))
    fitted = checked.withColumn("_counts", prompt_token_counts(good, vocab, spark)).withColumn(
        "_fit",
        fit_context(good, F.col("_counts"), F.col("_config.max_new_tokens"), max_seq_len),
    )
    kept = F.slice(good, F.col("_fit.first") + 1, F.size(good))
    too_big = F.lit(CONTEXT_TOO_LONG_TEXT)
    outcome = (
        F.when(F.col("_config.error").isNotNull(), F.lit("invalid_parameter"))
        .when(F.col("_bad").isNotNull(), F.col("_bad.code"))
        .when(F.col("_fit").isNull(), F.lit("context_too_long"))
        .otherwise(F.lit("accepted"))
    )
    return fitted.select(
        *log.columns,
        *(
            F.col(f"_config.{name}").alias(name)
            for name in ("max_new_tokens", "temperature", "top_p", "top_k", "repetition_penalty")
        ),
        outcome.alias("outcome"),
        F.coalesce(F.col("_config.error"), F.col("_bad.text"), F.when(usable & F.col("_fit").isNull(), too_big)).alias("error"),
        F.when(F.col("_fit").isNotNull(), F.size(kept)).alias("kept_turns"),
        F.col("_fit.used").alias("used_tokens"),
        F.when(F.col("_fit").isNotNull(), format_history(kept)).alias("prompt"),
    )
