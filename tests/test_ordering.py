import duckdb
import pytest
from compare import differences
from pyspark.sql import functions as F

from tessera.operators import ordering, skew
from tessera.operators.skew import first_rows, join_one_per_key
from tessera.plans.catalogue import ALL
from tessera.sources.corpora import CORPORA, CorpusSpec, first_prompts, load_corpus, rename_text


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(2000).select(F.col("id").alias("key"), F.concat(F.lit("example "), "id").alias("text"))


def keys(df):
    return [r["key"] for r in df.select("key").collect()]


def test_order_is_deterministic_and_complete(rows):
    positions = {r["pos"]: r["key"] for r in ordering.with_positions(rows, "key").collect()}
    assert sorted(positions) == list(range(2000))
    expected = keys(rows.orderBy(ordering.order_key("key"), "key"))
    assert [positions[i] for i in range(2000)] == expected
    other = {r["pos"]: r["key"] for r in ordering.with_positions(rows, "key", seed=7).collect()}
    assert other != positions and sorted(other.values()) == sorted(positions.values())


def test_physical_shuffle_keeps_every_row_in_order(rows):
    laid_out = ordering.seeded_shuffle(rows, "key", partitions=5)
    assert keys(laid_out) == keys(rows.orderBy(ordering.order_key("key"), "key"))


@pytest.mark.parametrize("n", [0, 1, 100, 1999, 2000, 5000])
def test_holdout_is_disjoint_and_complete(rows, n):
    train, val = ordering.holdout_split(rows, "key", n)
    train, val = keys(train), keys(val)
    assert len(val) == min(n, 2000)
    assert sorted(train + val) == list(range(2000))
    ordered = keys(rows.orderBy(ordering.order_key("key"), "key"))
    assert sorted(val) == sorted(ordered[:n])


def test_tokenizer_sample_follows_the_holdout(rows):
    ordered = keys(rows.orderBy(ordering.order_key("key"), "key"))
    assert sorted(keys(ordering.tokenizer_sample(rows, "key", 100, 300))) == sorted(ordered[100:400])
    assert len(keys(ordering.tokenizer_sample(rows, "key", 1900, 300))) == 100


def test_leakage_is_found(spark):
    train = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "key long, text string")
    val = spark.createDataFrame([(9, "a"), (8, "c")], "key long, text string")
    assert sorted(keys(ordering.split_leakage(train, val))) == [1, 3]


def test_batches_drop_the_ragged_tail(rows):
    batched = ordering.with_batches(rows, "key", 64).collect()
    assert len(batched) == 2000 // 64 * 64
    assert {(r["batch_no"], r["slot"]) for r in batched} == {(b, s) for b in range(31) for s in range(64)}


def test_step_plan_wraps_into_new_epochs(spark):
    plan = ordering.step_plan(spark, 2, 1, 3).orderBy("micro").collect()
    assert [r["batch_no"] for r in plan] == [0, 1, 0]
    assert [r["epoch"] for r in plan] == [0, 0, 1]
    assert [r["batch_no"] for r in ordering.step_plan(spark, 5, 1, 3).orderBy("micro").collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        ordering.step_plan(spark, 0, 1)


def test_native_val_is_capped_in_source_order(spark):
    source = spark.range(1500).select(F.col("id").alias("key"))
    assert keys(ordering.native_val(source, "key")) == list(range(1000))


def test_spec_needs_exactly_one_policy():
    for extra in ({}, {"val_split": "test", "val_holdout_examples": 5}):
        with pytest.raises(ValueError):
            CorpusSpec("p", None, "train", **extra)
    assert {s.messages_column for s in CORPORA.values()} == {None, "messages"}


def test_rename_is_skipped_for_chat_corpora(spark):
    df = spark.createDataFrame([("x",)], "Text string")
    plain = CorpusSpec("p", None, "train", text_column="Text", val_split="test")
    chat = CorpusSpec("p", None, "train", text_column="Text", val_split="test", messages_column="messages")
    assert rename_text(df, plain).columns == ["text"]
    assert rename_text(df, chat).columns == ["Text"]


def test_load_corpus_with_both_policies(spark, tmp_path):
    carved = CorpusSpec("carved", "small", "train", val_holdout_examples=5)
    native = CorpusSpec("native", None, "train", text_column="Text", val_split="test")
    data = spark.range(20).select(F.col("id").alias("key"), F.concat(F.lit("example "), "id").alias("text"))
    data.write.parquet(carved.location(str(tmp_path), "train"))
    for split in ("train", "test"):
        data.withColumnRenamed("text", "Text").write.parquet(native.location(str(tmp_path), split))
    train, val = load_corpus(spark, carved, str(tmp_path), "key")
    assert len(keys(val)) == 5 and sorted(keys(train) + keys(val)) == list(range(20))
    train, val = load_corpus(spark, native, str(tmp_path), "key")
    assert train.columns == ["key", "text"] and keys(val) == list(range(20))


def test_first_prompts(spark):
    df = spark.createDataFrame(
        [(2, [("user", "b")]), (1, [("user", "a"), ("assistant", "x")]), (3, [("user", "c")])],
        "key long, prompt array<struct<role:string,content:string>>",
    )
    assert [tuple(r) for r in first_prompts(df, "key", 2).collect()] == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("salted_from", [1, 1000])
def test_first_rows_with_a_hot_group(spark, monkeypatch, salted_from):
    """One group holds most rows; the salted way must agree with the direct one."""
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 7 + 1).alias("g"), F.col("id").alias("o")
    )
    monkeypatch.setattr(skew, "SALTED_FROM", salted_from)
    got = {(r["g"], r["o"], r["row_no"]) for r in first_rows(df, ["g"], ["o"], 30).collect()}
    want, seen = set(), {}
    for r in sorted(df.collect(), key=lambda r: r["o"]):
        seen[r["g"]] = seen.get(r["g"], 0) + 1
        if seen[r["g"]] <= 30:
            want.add((r["g"], r["o"], seen[r["g"]]))
    assert got == want


def test_group_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("o"))
    plan = first_rows(df, ["g"], ["o"], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("WindowGroupLimit", plan.index("Exchange"))


def test_join_with_hot_keys_keeps_every_row(spark):
    hot = spark.range(9000).select(F.lit(1).alias("g"), F.col("id").alias("o"))
    cold = spark.range(3000).select((F.col("id") % 1500 + 2).cast("int").alias("g"), F.col("id").alias("o"))
    rows = hot.unionByName(cold)
    per_key = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("o").alias("top"))
    joined = join_one_per_key(rows, per_key, ["g"], "n")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, rows.join(per_key, "g").collect()))


def test_chat_corpus_counts_its_whole_validation_split(spark, tmp_path):
    """1,100 of the conversations are validation, more than the first 1,000."""
    query, sql = ALL["chat_corpus"]
    turns = spark.range(4400).select(
        F.col("id").alias("conv_id"),
        F.explode(F.expr("array(named_struct('turn', 0L, 'role', 'user', 'text', concat('question ', id)), "
                         "named_struct('turn', 1L, 'role', 'assistant', 'text', repeat('answer', 1 + id % 9)))")).alias("t"),
    )
    turns.select("conv_id", "t.*").write.parquet(f"{tmp_path}/conversations.parquet")
    counted = {r["split"]: r["n_docs"] for r in query(spark, str(tmp_path)).collect()}
    assert counted == {"train": 3300, "val": 1100}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert differences(spark, con, query, sql, str(tmp_path)) is None
