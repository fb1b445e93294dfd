"""Score tables (row_id, token_id, logit): penalties, cut-offs, distributions, draws and losses.

A row has one score per vocabulary entry, so a group is never larger than the vocabulary. All
windows partition by ``row_id`` and share one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.fixed_values import IGNORE_INDEX, SEED

ROW = "row_id"
TOKEN = "token_id"
LOGIT = "logit"


def _per_row() -> Window:
    return Window.partitionBy(ROW)


def _ranked() -> Window:
    return _per_row().orderBy(F.desc(LOGIT), TOKEN)


def repetition_penalty(scores: DataFrame, seen: DataFrame, penalty: float) -> DataFrame:
    """Push down the scores of tokens listed in ``seen`` (row_id, token_id), each once."""
    if penalty == 1.0:
        return scores
    marks = seen.select(ROW, TOKEN).distinct().withColumn("_seen", F.lit(True))
    lowered = F.when(F.col(LOGIT) < 0, F.col(LOGIT) * penalty).otherwise(F.col(LOGIT) / penalty)
    return (
        scores.join(marks, [ROW, TOKEN], "left")
        .withColumn(LOGIT, F.when(F.col("_seen"), lowered).otherwise(F.col(LOGIT)))
        .drop("_seen")
    )


def temperature(scores: DataFrame, t: float) -> DataFrame:
    return scores.withColumn(LOGIT, F.col(LOGIT) / t)


def top_k(scores: DataFrame, k: int) -> DataFrame:
    """Scores at least as high as the k-th highest of their row; ties stay."""
    if k <= 0:
        return scores
    by_score = _per_row().orderBy(F.desc(LOGIT))
    return scores.withColumn("_rank", F.rank().over(by_score)).where(F.col("_rank") <= k).drop("_rank")


def softmax(scores: DataFrame) -> DataFrame:
    """Add ``prob`` per row."""
    shifted = F.exp(F.col(LOGIT) - F.max(LOGIT).over(_per_row()))
    return (
        scores.withColumn("_e", shifted)
        .withColumn("prob", F.col("_e") / F.sum("_e").over(_per_row()))
        .drop("_e")
    )


def top_p(scores: DataFrame, p: float) -> DataFrame:
    """Tokens before which at most mass ``p`` lies; the likeliest always stays."""
    if p >= 1.0:
        return scores
    before = _ranked().rowsBetween(Window.unboundedPreceding, -1)
    return (
        softmax(scores)
        .withColumn("_before", F.sum("prob").over(before))
        .where(F.col("_before").isNull() | (F.col("_before") <= p))
        .drop("_before", "prob")
    )


def greedy(scores: DataFrame) -> DataFrame:
    """(row_id, token_id) of the highest score, ties to the smallest id; aggregated map-side."""
    best = F.max(F.struct(F.col(LOGIT), (-F.col(TOKEN)).alias("negative")))
    return scores.groupBy(ROW).agg(best.alias("_b")).select(ROW, (-F.col("_b.negative")).alias(TOKEN))


def uniform(row: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the row only."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), row.cast("string"))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / float(16**12)


def seeded_draw(scores: DataFrame, seed: int = SEED) -> DataFrame:
    """(row_id, token_id): one draw per row by probability, the same on every run."""
    upto = _per_row().orderBy(TOKEN).rowsBetween(Window.unboundedPreceding, 0)
    reached = softmax(scores).withColumn("_upto", F.sum("prob").over(upto))
    hit = F.when(F.col("_upto") > uniform(F.col(ROW), seed), F.col(TOKEN))
    # Rounding may leave the sum a hair below the number drawn: then the last token.
    return reached.groupBy(ROW).agg(F.coalesce(F.min(hit), F.max(TOKEN)).alias(TOKEN))


def sample_tokens(
    scores: DataFrame, seen: DataFrame, t: float = 1.0, penalty: float = 1.0, k: int = 0,
    p: float = 1.0, seed: int = SEED,
) -> DataFrame:
    """One token per row: penalty, then the best token at temperature 0, else temperature,
    top-k, top-p and a draw."""
    scores = repetition_penalty(scores, seen, penalty)
    if t == 0.0:
        return greedy(scores)
    return seeded_draw(top_p(top_k(temperature(scores, t), k), p), seed)


def log_probs(scores: DataFrame) -> DataFrame:
    """Add ``log_prob``, the log of the softmax."""
    top = F.max(LOGIT).over(_per_row())
    return (
        scores.withColumn("_top", top)
        .withColumn("_sum", F.sum(F.exp(F.col(LOGIT) - F.col("_top"))).over(_per_row()))
        .withColumn("log_prob", F.col(LOGIT) - F.col("_top") - F.log("_sum"))
        .drop("_top", "_sum")
    )


def _counts_as_target() -> Column:
    return (F.col("label") != IGNORE_INDEX) & (F.col("position") >= 1)


def masked_loss(targets: DataFrame, *by: str) -> DataFrame:
    """Mean negative log-likelihood over supervised targets of (.., position, label, log_prob)."""
    nll = F.when(_counts_as_target(), -F.col("log_prob"))
    return targets.groupBy(*by).agg(F.avg(nll).alias("loss"), F.count(nll).alias("n_targets"))


def validation_loss(targets: DataFrame, batch: str = "batch_no") -> DataFrame:
    """One row: the mean of the batches' means and, beside it, the mean over all targets. NULL
    when there is no full batch."""
    return masked_loss(targets, batch).agg(
        F.avg("loss").alias("batch_mean_loss"),
        (F.sum(F.col("loss") * F.col("n_targets")) / F.sum("n_targets")).alias("token_mean_loss"),
        F.count("loss").alias("n_batches"),
    )
