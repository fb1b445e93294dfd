import json

import pytest
from pyspark.sql import functions as F
from test_pairs import CASES, first_word_judge, frame

from tessera.operators.examples import pretraining_examples
from tessera.operators.pairs import judge_pairs, preference_pairs, sample_pairs
from tessera.operators.replies import assemble_replies
from tessera.plans.preferences import stub_completer
from tessera.session import scratch_path
from tessera.sources.jsonl import PREFERENCE_SCHEMA, RAW_PAIRS_SCHEMA, append_lines, read_lines, recover
from tessera.sources.logs import evaluations, read_chunks, read_request_log, read_run_log
from tessera.streaming.incremental import encode_stream, generate_stream, judge_stream, read_new_files
from tessera.streaming.replies import STATE_STORE, reply_stream


def test_broken_lines_are_quarantined_with_a_reason(spark, tmp_path):
    good = {"prompt": "p", "chosen": "c", "rejected": "r"}
    lines = [json.dumps(good), "", "  ", "\0" * 30, json.dumps(good)[:9], json.dumps({"prompt": "p", "chosen": "c"}), json.dumps(good)]
    path = tmp_path / "pairs.jsonl"
    path.write_text("\n".join(lines) + "\n")
    kept, bad = recover(read_lines(spark, str(path), PREFERENCE_SCHEMA))
    assert [r.asDict() for r in kept.collect()] == [good, good]
    reasons = sorted(r["reason"] for r in bad.collect())
    assert reasons == ["malformed_line", "malformed_line", "missing rejected"]


def test_lines_are_appended(spark, tmp_path):
    df = spark.createDataFrame([("p", "a", None)], RAW_PAIRS_SCHEMA)
    for _ in range(2):
        append_lines(df, str(tmp_path / "out"))
    back = spark.read.schema(RAW_PAIRS_SCHEMA).json(str(tmp_path / "out"))
    assert [tuple(r) for r in back.collect()] == [("p", "a", None)] * 2


def test_run_log(spark, tmp_path):
    folder = tmp_path / "v1"
    folder.mkdir()
    records = [
        {"message": "val_loss 3.0 at step 500", "timestamp": "2026-08-13T10:00:00.123456+00:00", "step": 500, "val_loss": 3.0},
        {"message": "saved checkpoint at step 500", "timestamp": "2026-08-13T10:00:01+00:00", "step": 500},
        {"message": "judge pipeline complete", "timestamp": "bad", "kept": 3, "discard_counts": {"api_failure": 2}},
    ]
    (folder / "app.log").write_text("".join(json.dumps(r) + "\n" for r in records))
    log = read_run_log(spark, str(folder))
    assert {r["run"] for r in log.collect()} == {"v1"} and evaluations(log).first()["val_loss"] == 3.0
    last = log.where("kept = 3").first()
    assert last["timestamp"] is None and last["discard_counts"] == {"api_failure": 2}
    assert log.where("timestamp IS NOT NULL").count() == 2


def test_request_and_chunk_logs(spark, tmp_path):
    (tmp_path / "req.log").write_text('{"input": {}}\nnot json\n{"input": {}}\n{"id": "own"}\n')
    read = {r["request_id"]: r["payload"] for r in read_request_log(spark, str(tmp_path / "req.log")).collect()}
    assert len(read) == 4 and read["own"] == '{"id": "own"}' and list(read.values()).count('{"input": {}}') == 2
    (tmp_path / "chunks.jsonl").write_text('{"request_id": "a", "seq": 0, "token": "x", "done": false}\n')
    assert tuple(read_chunks(spark, str(tmp_path / "chunks.jsonl")).first()) == ("a", 0, "x", False, None)


def test_stopped_stream_goes_on_without_loss_or_repeats(spark):
    base = scratch_path(spark, "resume-test")
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))

    def run():
        stream = read_new_files(spark, f"{base}/in", docs.schema, files_per_batch=2)
        encode_stream(stream, f"{base}/out", f"{base}/progress", max_seq_len=16).awaitTermination()

    docs.where("doc_id < 16").repartition(4).write.parquet(f"{base}/in")
    run()
    assert spark.read.parquet(f"{base}/out").count() == 16
    run()  # nothing new
    docs.where("doc_id >= 16").repartition(3).write.mode("append").parquet(f"{base}/in")
    run()
    streamed = {r["doc_id"]: r["input_ids"] for r in spark.read.parquet(f"{base}/out").collect()}
    batch = {r["doc_id"]: r["input_ids"] for r in pretraining_examples(docs, max_seq_len=16).collect()}
    assert streamed == batch and spark.read.parquet(f"{base}/out").count() == 40


def test_interrupted_stream_repeats_nothing(spark):
    """The sink fails in the middle of a run; the restarted query finishes the job."""
    base = scratch_path(spark, "interrupted")
    cases = frame(spark, CASES)
    cases.repartition(8, "key").write.parquet(f"{base}/in")

    factory = first_word_judge

    def run(fail):
        stream = read_new_files(spark, f"{base}/in", cases.schema, files_per_batch=1)
        if fail:
            def breaking(batch, number):
                if number == 2:
                    raise RuntimeError("lost")
                judged = judge_pairs(batch, factory, f"{base}/ledger/batch={number}", retry_seconds=0.0)
                preference_pairs(judged).write.mode("overwrite").json(f"{base}/out/batch={number}")

            query = stream.writeStream.foreachBatch(breaking).option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
        else:
            query = judge_stream(stream, factory, f"{base}/ledger", f"{base}/out", f"{base}/progress", retry_seconds=0.0)
        query.awaitTermination()

    with pytest.raises(Exception):
        run(fail=True)
    run(fail=False)
    kept = spark.read.schema(PREFERENCE_SCHEMA).json(f"{base}/out").collect()
    assert sorted((r["prompt"], r["chosen"]) for r in kept) == [("A B", "a text"), ("B A", "b longer")]
    forward = spark.read.parquet(f"{base}/ledger/*/forward")
    assert forward.count() == forward.select("key").distinct().count() == 13


def test_generated_pairs_stream(spark):
    base = scratch_path(spark, "generated")
    prompts = spark.createDataFrame([(1, "hello"), (2, "bye")], "key int, prompt string")
    prompts.write.parquet(f"{base}/in")
    stream = read_new_files(spark, f"{base}/in", prompts.schema)
    generate_stream(stream, lambda df: sample_pairs(df, stub_completer), f"{base}/out", f"{base}/progress").awaitTermination()
    back = spark.read.schema("key int, " + RAW_PAIRS_SCHEMA).json(f"{base}/out")
    assert sorted(r["prompt"] for r in back.collect()) == ["bye", "hello"]


def test_streamed_replies_equal_the_batch(spark):
    """Chunks in any order over several files and a restart; what stays open is closed by its timer."""
    rows = []
    for request in range(12):
        words = [f"{request}:{i} " for i in range(request % 4 + 1)]
        rows += [(request, i, w, False, None) for i, w in enumerate(words)]
        if request % 3 != 1:
            rows.append((request, len(words), None, True, "boom" if request % 3 == 2 else None))
    schema = "request_id long, seq long, token string, done boolean, error string"
    chunks = spark.createDataFrame(rows, schema)
    timed = chunks.withColumn("at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("request_id")))
    base = scratch_path(spark, "replies")
    before = spark.conf.get(STATE_STORE[0], None)
    spark.conf.set(*STATE_STORE)
    try:
        parity = F.pmod(F.xxhash64("request_id", "seq"), F.lit(3))
        late = spark.createDataFrame([(99, 1, None, True, None)], schema).withColumn("at", F.timestamp_seconds(F.lit(1_800_000_000)))
        waves = [timed.where(parity == 0), timed.where(parity != 0), late]
        for wave in waves:
            wave.coalesce(1).write.mode("append").parquet(f"{base}/in")
            stream = read_new_files(spark, f"{base}/in", timed.schema, files_per_batch=1).withWatermark("at", "1 minute")
            query = reply_stream(stream, 60).writeStream.format("parquet").option("path", f"{base}/out")
            query.option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start().awaitTermination()
        got = spark.read.parquet(f"{base}/out").where("request_id < 99").collect()
    finally:
        spark.conf.unset(STATE_STORE[0]) if before is None else spark.conf.set(STATE_STORE[0], before)
    assert sorted(map(tuple, got)) == sorted(map(tuple, assemble_replies(chunks).collect()))
