"""Fixed-length training examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.fixed_values import IGNORE_INDEX, MAX_SEQ_LEN, PAD_ID, PAD_TOKEN
from tessera.functions.bytes import byte_token_count
from tessera.functions.chat import format_prompt, format_turn
from tessera.functions.sequences import fit_length, labels_for
from tessera.operators.encoding import encode_ids
from tessera.operators.skew import first_rows
from tessera.operators.vocabulary import Vocabulary

# The markup of a turn alone is six bytes, which are six tokens without merges. With merges it is
# at least two, as brackets and a line break are never one word.
MIN_TURN_BYTES = 6
MIN_TURN_WORDS = 2


def pretraining_examples(
    docs: DataFrame, vocab: Vocabulary | None = None, max_seq_len: int = MAX_SEQ_LEN, text: str = "text"
) -> DataFrame:
    """One document per row: ``input_ids`` cut or padded to length, ``labels`` without padding,
    and ``n_tokens`` before the cut. Row-local, no shuffle."""
    ids = encode_ids(F.col(text), vocab or Vocabulary(), docs.sparkSession)
    return (
        docs.withColumn("_ids", ids)
        .withColumn("n_tokens", F.size("_ids"))
        .withColumn("input_ids", fit_length(F.col("_ids"), max_seq_len))
        .withColumn("labels", labels_for(F.col("input_ids")))
        .drop("_ids")
    )


def pretraining_counts(
    docs: DataFrame, vocab: Vocabulary | None = None, max_seq_len: int = MAX_SEQ_LEN, text: str = "text"
) -> DataFrame:
    """``n_tokens`` before the cut and ``n_targets`` of each document's example, which is not built.

    Every kept token but the first is a target, unless it is a literal padding token. Without merges
    tokens are only listed for texts that hold one.
    """
    ids = encode_ids(F.col(text), vocab or Vocabulary(), docs.sparkSession)

    def targets(n: Column) -> Column:
        return F.greatest(F.least(n, F.lit(max_seq_len)) - 1, F.lit(0))

    def listed(ids: Column) -> Column:
        return F.size(F.filter(F.slice(ids, 2, max_seq_len - 1), lambda i: i != PAD_ID))

    if vocab is not None and vocab.merges:
        counted = docs.withColumn("_ids", ids).withColumn("n_tokens", F.size("_ids"))
        return counted.withColumn("n_targets", listed(F.col("_ids"))).drop("_ids")
    counted = docs.withColumn("n_tokens", byte_token_count(F.col(text)).cast("int"))
    plain = targets(F.col("n_tokens"))
    return counted.withColumn("n_targets", F.when(F.contains(F.col(text), F.lit(PAD_TOKEN)), listed(ids)).otherwise(plain))


def chat_examples(
    turns: DataFrame, vocab: Vocabulary | None = None, max_seq_len: int = MAX_SEQ_LEN,
    key: str = "conv_id", order: str = "turn", role: str = "role", content: str = "text",
) -> DataFrame:
    """(key, input_ids, labels, kept_ids, truncated, error): every assistant turn and the stop token
    after it is supervised, all else is ignored. A conversation with a NULL role or text among the
    turns looked at is no example: ``error`` is ``null_turn`` and the other columns are NULL.

    Turns that start at or behind ``max_seq_len`` cannot show in the example. Because each turn
    has a least number of tokens, only so many leading turns are encoded, and only those that start
    in range are gathered: fewer than ``2 * max_seq_len`` ids of a conversation, however long.
    """
    vocab = vocab or Vocabulary()
    needed = max_seq_len // (MIN_TURN_WORDS if vocab.merges else MIN_TURN_BYTES) + 1
    leading = first_rows(turns.select(key, order, role, content), [key], [order], needed)
    broken = F.col(role).isNull() | F.col(content).isNull()
    supervised = F.coalesce(F.col(role) == "assistant", F.lit(False))
    ids = encode_ids(format_turn(F.col(role), F.col(content)), vocab, turns.sparkSession)
    encoded = (
        leading.withColumn("_turn", ids)
        .withColumn(
            "_ids", F.when(supervised, F.array_append("_turn", F.lit(PAD_ID))).otherwise(F.col("_turn"))
        )
        .withColumn("_n", F.coalesce(F.size("_ids"), F.lit(0)))
        .withColumn("_broken", broken)
    )
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = encoded.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    placed = placed.withColumn("_ids", F.slice("_ids", 1, max_seq_len))
    # A turn behind the limit shows in the total, not in the example.
    part = F.struct(F.col("_start"), F.col("_ids"), supervised.alias("_supervised"))
    parts = F.array_sort(F.collect_list(F.when(F.col("_start") < max_seq_len, part)))
    ignored = F.lit(IGNORE_INDEX)

    def part_labels(part: Column) -> Column:
        masked = F.transform(part["_ids"], lambda _: ignored)
        return F.when(part["_supervised"], part["_ids"]).otherwise(masked)

    return (
        placed.groupBy(key)
        .agg(
            parts.alias("_parts"),
            F.max(F.col("_start") + F.col("_n")).alias("_total"),
            F.bool_or("_broken").alias("_broken"),
        )
        .withColumn("_parts", F.when(~F.col("_broken"), F.col("_parts")))
        .withColumn("_total", F.when(~F.col("_broken"), F.col("_total")))
        .select(
            key,
            "_total",
            "_broken",
            F.flatten(F.transform("_parts", lambda p: p["_ids"])).alias("_ids"),
            F.flatten(F.transform("_parts", part_labels)).alias("_labels"),
        )
        .select(
            key,
            fit_length(F.col("_ids"), max_seq_len).alias("input_ids"),
            fit_length(F.col("_labels"), max_seq_len, IGNORE_INDEX).alias("labels"),
            F.least("_total", F.lit(max_seq_len)).cast("int").alias("kept_ids"),
            (F.col("_total") > max_seq_len).alias("truncated"),
            F.when(F.col("_broken"), F.lit("null_turn")).alias("error"),
        )
    )


def preference_prompts(pairs: DataFrame) -> DataFrame:
    """Preference pairs with the prompt in chat markup; answers unchanged."""
    return pairs.withColumn("prompt", format_prompt(F.col("prompt")))


def preference_examples(
    pairs: DataFrame, vocab: Vocabulary | None = None, max_length: int = MAX_SEQ_LEN
) -> DataFrame:
    """Encoded preference pairs (prompt in chat markup): ``prompt_ids``, and per answer the padded
    ``*_ids`` of prompt and answer with a ``*_mask`` that is 1 on the answer's tokens. An answer
    gets the stop token unless it already ends in it."""
    spark = pairs.sparkSession
    vocab = vocab or Vocabulary()
    coded = pairs.withColumn("prompt_ids", encode_ids(F.col("prompt"), vocab, spark))
    for side in ("chosen", "rejected"):
        answer = F.col(side)
        ended = F.when(F.endswith(answer, F.lit(PAD_TOKEN)), answer).otherwise(
            F.concat(answer, F.lit(PAD_TOKEN))
        )
        coded = coded.withColumn(f"_{side}", encode_ids(ended, vocab, spark))
    for side in ("chosen", "rejected"):
        answer = F.col(f"_{side}")
        zeros = F.transform("prompt_ids", lambda _: F.lit(0))
        ones = F.transform(answer, lambda _: F.lit(1))
        coded = (
            coded.withColumn(f"{side}_ids", fit_length(F.concat("prompt_ids", answer), max_length))
            .withColumn(f"{side}_mask", fit_length(F.concat(zeros, ones), max_length, 0))
        )
    return coded.drop("_chosen", "_rejected")
