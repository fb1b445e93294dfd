import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import dense_scores as D
from tessera.functions.sequences import target_count
from tessera.operators import runs
from tessera.operators import scores as S
from tessera.operators.budget import corpus_report, tokens_per_step
from tessera.operators.examples import chat_examples, pretraining_examples


def table(spark, *rows):
    return spark.createDataFrame(
        [(r, t, float(x)) for r, row in enumerate(rows) for t, x in enumerate(row)],
        "row_id long, token_id int, logit double",
    )


def logits(df, row=0):
    return [r["logit"] for r in df.where(F.col("row_id") == row).orderBy("token_id").collect()]


def tokens(df, row=0):
    return sorted(r["token_id"] for r in df.where(F.col("row_id") == row).collect())


def seen(spark, *ids):
    return spark.createDataFrame([(0, i) for i in ids], "row_id long, token_id int")


def test_penalty(spark):
    assert logits(S.repetition_penalty(table(spark, [5, 1, -2]), seen(spark, 0, 0), 2.0)) == [2.5, 1.0, -2.0]
    assert logits(S.repetition_penalty(table(spark, [-2, 1]), seen(spark, 0), 2.0)) == [-4.0, 1.0]
    assert logits(S.repetition_penalty(table(spark, [5, 1]), seen(spark, 0), 1.0)) == [5.0, 1.0]


def test_top_k(spark):
    df = table(spark, [5, 4, 3, 2, 1], [1, 3, 3, 2, 0])
    assert tokens(S.top_k(df, 2)) == [0, 1]
    assert tokens(S.top_k(df, 1), 1) == [1, 2]  # ties stay
    assert len(tokens(S.top_k(df, 0))) == len(tokens(S.top_k(df, 9))) == 5


def test_top_p(spark):
    df = table(spark, [math.log(x) for x in (0.5, 0.3, 0.15, 0.05)])
    assert tokens(S.top_p(df, 0.4)) == [0]
    assert tokens(S.top_p(df, 0.7)) == [0, 1]
    assert tokens(S.top_p(df, 0.0)) == [0]
    assert len(tokens(S.top_p(df, 1.0))) == 4


def test_greedy_and_temperature_zero(spark):
    df = table(spark, [1, 7, 7], [3, 2, 1])
    assert {r["row_id"]: r["token_id"] for r in S.greedy(df).collect()} == {0: 1, 1: 0}
    got = S.sample_tokens(df, seen(spark, 1), t=0.0, penalty=2.0)
    assert {r["row_id"]: r["token_id"] for r in got.collect()} == {0: 2, 1: 0}


def test_softmax_sums_to_one_and_survives_large_scores(spark):
    probs = [r["prob"] for r in S.softmax(table(spark, [1000, 999, -1000])).collect()]
    assert sum(probs) == pytest.approx(1.0)


def test_draws_follow_the_distribution_and_repeat(spark):
    weights = (0.6, 0.3, 0.1)
    rows = spark.range(4000).select(
        F.col("id").alias("row_id"), F.posexplode(F.array(*(F.lit(math.log(w)) for w in weights))).alias("token_id", "logit"))
    first = {r["row_id"]: r["token_id"] for r in S.seeded_draw(rows).collect()}
    again = {r["row_id"]: r["token_id"] for r in S.seeded_draw(rows.repartition(3)).collect()}
    assert first == again and len(first) == 4000
    for token, weight in enumerate(weights):
        assert abs(sum(t == token for t in first.values()) / 4000 - weight) < 0.03


def test_dense_scores(spark):
    def one(expr, *values):
        df = spark.createDataFrame([(list(map(float, values)),)], "x array<double>")
        return df.select(expr(F.col("x"))).first()[0]

    assert one(lambda x: D.keep_top_k(x, 2), 5, 4, 3) == [5.0, 4.0, None]
    assert one(lambda x: D.keep_top_k(x, 1), 1, 3, 3) == [None, 3.0, 3.0]
    assert one(lambda x: D.keep_top_k(x, 9), 1, 3) == one(lambda x: D.keep_top_k(x, 0), 1, 3) == [1.0, 3.0]
    logs = [math.log(v) for v in (0.15, 0.5, 0.05, 0.3)]
    assert one(lambda x: D.keep_top_p(x, 0.4), *logs) == [None, logs[1], None, None]
    assert one(lambda x: D.keep_top_p(x, 0.7), *logs) == [None, logs[1], None, logs[3]]
    assert one(lambda x: D.keep_top_p(x, 0.0), 2, 2) == [2.0, None]
    assert one(lambda x: D.keep_top_p(D.keep_top_k(x, 2), 0.99), *logs) == [None, logs[1], None, logs[3]]
    assert one(lambda x: D.best_token(x), 1, 7, 7) == 1
    assert one(lambda x: D.probabilities(D.keep_top_k(x, 1)), 1000, 2, -1000) == [1.0, 0.0, 0.0]
    assert one(lambda x: D.drawn_token(x, F.lit(0.0)), *logs) == 0
    assert one(lambda x: D.drawn_token(x, F.lit(0.6)), *logs) == 1
    assert one(lambda x: D.drawn_token(D.keep_top_k(x, 1), F.lit(1.0)), *logs) == 1


def test_losses(spark):
    rows = [(0, 0, 0, 5, -9.0), (0, 0, 1, -100, -9.0), (0, 0, 2, 2, -1.0), (1, 1, 1, 3, -2.0), (1, 1, 2, 3, -4.0)]
    df = spark.createDataFrame(rows, "batch_no long, example long, position long, label int, log_prob double")
    assert S.masked_loss(df, "example").where("example = 0").first()["loss"] == 1.0
    row = S.validation_loss(df).first()
    assert row["batch_mean_loss"] == 2.0 and row["token_mean_loss"] == pytest.approx(7 / 3)
    empty = S.validation_loss(df.where("false")).first()
    assert empty["batch_mean_loss"] is None and empty["n_batches"] == 0


def test_log_probs(spark):
    got = [r["log_prob"] for r in S.log_probs(table(spark, [2, 1])).orderBy("token_id").collect()]
    norm = math.log(math.exp(2) + math.exp(1))
    assert got == pytest.approx([2 - norm, 1 - norm])


def test_run_summary_and_flat_tail(spark):
    rows = [("v0", s, loss, "val") for s, loss in ((500, 4.0), (1000, 3.4), (9500, 3.005), (10000, 3.0))]
    rows += [("v0", s, None, "saved checkpoint at step") for s in (125, 250)]
    rows += [("v1", 500, 2.0, "val")]
    df = spark.createDataFrame(rows, "run string, step long, val_loss double, message string")
    got = {r["run"]: r for r in runs.run_summary(df).collect()}
    assert (got["v0"]["last_step"], got["v0"]["last_val_loss"], got["v0"]["n_evals"], got["v0"]["n_checkpoints"]) == (10000, 3.0, 4, 2)
    tail = {r["run"]: r for r in runs.flat_tail(df).collect()}
    assert tail["v0"]["first_drop"] == pytest.approx(0.6) and tail["v0"]["last_drop"] == pytest.approx(0.005)
    assert tail["v1"]["first_drop"] == 0.0 and tail["v1"]["last_drop"] is None


def test_budget(spark):
    assert tokens_per_step() == 524288
    df = spark.createDataFrame([("s", 10, 7), ("s", 3, 2), ("s", 0, 0)], "source string, n_tokens int, n_targets int")
    row = corpus_report(df, ["source"], max_seq_len=8, batch_size=1, accumulation=2).first()
    assert (row["raw_tokens"], row["kept_tokens"], row["pad_tokens"], row["targets"], row["truncated"]) == (13, 11, 13, 9, 1)
    assert (row["n_batches"], row["n_steps"], row["step_tokens"]) == (3, 1, 16)


def test_budget_counts_targets_from_labels(spark):
    """A literal stop token is no target; a conversation's targets are its answers."""
    docs = spark.createDataFrame([("d", "ab[PAD]cd")], "source string, text string")
    counted = pretraining_examples(docs, max_seq_len=16).withColumn("n_targets", target_count(F.col("labels")))
    assert corpus_report(counted, ["source"], max_seq_len=16).first()["targets"] == 3
    turns = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], "conv_id long, turn long, role string, text string")
    chats = chat_examples(turns, max_seq_len=64).select(
        F.lit("chat").alias("source"), F.col("kept_ids").alias("n_tokens"), target_count(F.col("labels")).alias("n_targets")
    )
    assert corpus_report(chats, ["source"], max_seq_len=64).first()["targets"] == len("<|assistant|>\na\n") + 1
