"""Queries over score tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import dense_scores as D
from tessera.operators import scores as S
from tessera.plans.sql import seeded
from tessera.plans.tables import (
    LOSS_BATCH,
    SCORES_SQL,
    TARGETS_SQL,
    dense_scores,
    loss_targets,
    scores,
    seen_tokens,
)

PENALTY = 1.3
K = 10
P = 0.6
HEAT = 0.7


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def repetition_penalty(spark: SparkSession, folder: str) -> DataFrame:
    lowered = S.repetition_penalty(scores(spark, folder), seen_tokens(spark, folder), PENALTY)
    return _rounded(lowered.select("row_id", "token_id", "logit"), "logit")


def top_k(spark: SparkSession, folder: str) -> DataFrame:
    # Coarse scores, so that ties occur.
    coarse = scores(spark, folder).withColumn("logit", F.round("logit", 0))
    return S.top_k(coarse, K).select("row_id", "token_id")


def top_p(spark: SparkSession, folder: str) -> DataFrame:
    return S.top_p(scores(spark, folder), P).select("row_id", "token_id")


def softmax_greedy(spark: SparkSession, folder: str) -> DataFrame:
    hot = S.temperature(scores(spark, folder), HEAT)
    best = S.greedy(hot).withColumnRenamed("token_id", "best")
    probs = S.softmax(hot).join(best, "row_id")
    return _rounded(
        probs.select("row_id", "token_id", "prob", (F.col("token_id") == F.col("best")).alias("is_best")), "prob"
    )


def seeded_draw(spark: SparkSession, folder: str) -> DataFrame:
    return S.seeded_draw(scores(spark, folder))


def sampled_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return S.sample_tokens(
        scores(spark, folder), seen_tokens(spark, folder), HEAT, PENALTY, K, P
    )


def masked_loss(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(S.masked_loss(loss_targets(spark, folder), "example"), "loss")


def val_loss(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(S.validation_loss(loss_targets(spark, folder, batched=True)), "batch_mean_loss", "token_mean_loss")


def _kept(df: DataFrame) -> DataFrame:
    """(row_id, token_id) of the scores that are left in each vector."""
    left = df.select("row_id", F.posexplode("logits").alias("token_id", "logit"))
    return left.where(F.col("logit").isNotNull()).select("row_id", "token_id")


def top_k_dense(spark: SparkSession, folder: str) -> DataFrame:
    coarse = F.transform("logits", lambda x: F.round(x, 0))
    return _kept(dense_scores(spark, folder).withColumn("logits", D.keep_top_k(coarse, K)))


def top_p_dense(spark: SparkSession, folder: str) -> DataFrame:
    return _kept(dense_scores(spark, folder).withColumn("logits", D.keep_top_p(F.col("logits"), P)))


def softmax_greedy_dense(spark: SparkSession, folder: str) -> DataFrame:
    hot = dense_scores(spark, folder).withColumn("logits", D.scaled(F.col("logits"), HEAT))
    probs = hot.select(
        "row_id", D.best_token(F.col("logits")).alias("best"),
        F.posexplode(D.probabilities(F.col("logits"))).alias("token_id", "prob"),
    )
    return _rounded(
        probs.select("row_id", "token_id", "prob", (F.col("token_id") == F.col("best")).alias("is_best")), "prob"
    )


def seeded_draw_dense(spark: SparkSession, folder: str) -> DataFrame:
    row = F.col("row_id")
    return dense_scores(spark, folder).select(
        "row_id", D.drawn_token(F.col("logits"), S.uniform(row)).alias("token_id")
    )


_U = "('0x' || substr(md5('42:' || row_id), 1, 12))::BIGINT / 281474976710656.0"
_SOFTMAX = "exp(l - max(l) OVER (PARTITION BY row_id))"


def _probs(source: str, logit: str = "logit") -> str:
    return f"""SELECT row_id, token_id, l, e / sum(e) OVER (PARTITION BY row_id) AS prob
        FROM (SELECT row_id, token_id, l, {_SOFTMAX} AS e FROM (SELECT row_id, token_id, {logit} AS l FROM {source}))"""


_SEEN = f"CASE WHEN (row_id + token_id) % 7 <> 0 THEN logit WHEN logit < 0 THEN logit * {PENALTY} ELSE logit / {PENALTY} END"
_NUCLEUS = "sum(prob) OVER (PARTITION BY row_id ORDER BY l DESC, token_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_DRAW = f"""SELECT row_id, coalesce(min(token_id) FILTER (WHERE upto > {_U}), max(token_id)) AS token_id
    FROM (SELECT *, sum(prob) OVER (PARTITION BY row_id ORDER BY token_id) AS upto FROM {{source}}) GROUP BY row_id"""

QUERIES = {
    "repetition_penalty": (
        repetition_penalty,
        f"WITH {SCORES_SQL} SELECT row_id, token_id, round({_SEEN}, 6) AS logit FROM scores",
    ),
    "top_k": (
        top_k,
        f"""WITH {SCORES_SQL} SELECT row_id, token_id FROM (
            SELECT *, rank() OVER (PARTITION BY row_id ORDER BY round(logit, 0) DESC) AS r FROM scores
        ) WHERE r <= {K}""",
    ),
    "top_p": (
        top_p,
        f"""WITH {SCORES_SQL}, p AS ({_probs('scores')})
        SELECT row_id, token_id FROM (SELECT *, {_NUCLEUS} AS before FROM p) WHERE before IS NULL OR before <= {P}""",
    ),
    "softmax_greedy": (
        softmax_greedy,
        f"""WITH {SCORES_SQL}, p AS ({_probs('scores', f'logit / {HEAT}')})
        SELECT row_id, token_id, round(prob, 6) AS prob,
            row_number() OVER (PARTITION BY row_id ORDER BY l DESC, token_id) = 1 AS is_best FROM p""",
    ),
    "seeded_draw": (
        seeded_draw, f"WITH {SCORES_SQL}, p AS ({_probs('scores')}) {_DRAW.format(source='p')}"
    ),
    "sampled_tokens": (
        sampled_tokens,
        f"""WITH {SCORES_SQL},
        hot AS (SELECT row_id, token_id, ({_SEEN}) / {HEAT} AS h FROM scores),
        few AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY row_id ORDER BY h DESC) AS r FROM hot) WHERE r <= {K}),
        p AS ({_probs('few', 'h')}),
        nucleus AS (SELECT * FROM (SELECT *, {_NUCLEUS} AS before FROM p) WHERE before IS NULL OR before <= {P}),
        q AS ({_probs('nucleus', 'l')})
        {_DRAW.format(source='q')}""",
    ),
    "masked_loss": (
        masked_loss,
        f"""WITH {TARGETS_SQL} SELECT example,
            round(avg(-log_prob) FILTER (WHERE label <> -100 AND position >= 1), 6) AS loss,
            count(*) FILTER (WHERE label <> -100 AND position >= 1) AS n_targets
        FROM targets GROUP BY example""",
    ),
    "val_loss": (
        val_loss,
        f"""WITH {TARGETS_SQL},
        placed AS (SELECT vec_id, (row_number() OVER (ORDER BY {seeded('vec_id')}, vec_id) - 1) // {LOSS_BATCH} AS batch_no
            FROM embeddings),
        used AS (SELECT t.*, p.batch_no FROM targets t JOIN placed p USING (vec_id)
            WHERE label <> -100 AND position >= 1
                AND p.batch_no < (SELECT count(*) FROM embeddings) // {LOSS_BATCH}),
        b AS (SELECT batch_no, avg(-log_prob) AS loss FROM used GROUP BY batch_no)
        SELECT round((SELECT avg(loss) FROM b), 6) AS batch_mean_loss,
            round((SELECT avg(-log_prob) FROM used), 6) AS token_mean_loss, (SELECT count(*) FROM b) AS n_batches""",
    ),
}
# The same results from score vectors.
QUERIES.update(
    {
        "top_k_dense": (top_k_dense, QUERIES["top_k"][1]),
        "top_p_dense": (top_p_dense, QUERIES["top_p"][1]),
        "softmax_greedy_dense": (softmax_greedy_dense, QUERIES["softmax_greedy"][1]),
        "seeded_draw_dense": (seeded_draw_dense, QUERIES["seeded_draw"][1]),
    }
)
