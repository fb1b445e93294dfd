import os
import json
import math
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tessera.operators import pairs as P
from tessera.plans.preferences import stub_completer
from tessera.sources.ledger import append_ledger, compact_ledger, pending, read_ledger

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def verdict(v):
    return json.dumps({"reasoning": "by rule", "verdict": v})


def first_word_judge():
    """Answers by the first words of the prompt: '<forward> <swapped>', told apart by which answer
    comes first."""
    def judge(request):
        prompt = request.split("<prompt>\n")[1].split("\n</prompt>")[0]
        first = request.split("<response_a>\n")[1].split("\n</response_a>")[0]
        word = prompt.split()[0 if first.startswith("a") else 1]
        if word == "fail":
            raise RuntimeError("no answer")
        return {"A": verdict("A"), "B": verdict("B"), "junk": "not json", "list": "[]",
                "none": '{"reasoning": "x"}', "C": verdict("C"), "one": '{"verdict": 1}', "null": None}[word]

    return judge


CASES = [
    ("A B", "a text", "b longer", None, "a text"),
    ("B A", "a text", "b longer", None, "b longer"),
    ("A A", "a", "b", "position_bias_disagreement", None),
    ("B B", "a", "b", "position_bias_disagreement", None),
    ("junk A", "a", "b", "parse_failure", None),
    ("none A", "a", "b", "parse_failure", None),
    ("C A", "a", "b", "parse_failure", None),
    ("one A", "a", "b", "parse_failure", None),
    ("null A", "a", "b", "parse_failure", None),
    ("list A", "a", "b", "api_failure", None),
    ("fail A", "a", "b", "api_failure", None),
    ("A fail", "a", "b", "api_failure", None),
    ("A junk", "a", "b", "parse_failure", None),
    ("A B", "a same", "a same", "degenerate_pair", None),
    ("A B", "a", " \n", "degenerate_pair", None),
    ("A B", "", "b", "degenerate_pair", None),
]


def frame(spark, cases):
    rows = [(i, c[0], c[1], c[2]) for i, c in enumerate(cases)]
    return spark.createDataFrame(rows, "key int, prompt string, completion_a string, completion_b string")


def judged(spark, path, cases=CASES, factory=first_word_judge, **options):
    return P.judge_pairs(frame(spark, cases), factory, str(path), retry_seconds=0.0, **options)


@pytest.mark.parametrize("options", [{}, {"rows_per_commit": 4, "concurrency": 2}])
def test_every_outcome(spark, tmp_path, options):
    rows = {r["key"]: r for r in judged(spark, tmp_path / "ledger", **options).collect()}
    assert len(rows) == len(CASES)
    for i, (_, a, b, reason, winner) in enumerate(CASES):
        r = rows[i]
        assert r["discard_reason"] == reason and r["kept"] == (reason is None), CASES[i]
        assert r["chosen"] == winner
        if winner is not None:
            loser = b if winner == a else a
            assert r["rejected"] == loser and r["length_ratio"] == len(winner) / len(loser)


def test_forward_failure_stops_before_the_swapped_call(spark, tmp_path):
    judged(spark, tmp_path / "ledger").count()
    swapped = {r["key"] for r in spark.read.parquet(str(tmp_path / "ledger/swapped")).collect()}
    assert swapped == {0, 1, 2, 3, 11, 12}
    forward = spark.read.parquet(str(tmp_path / "ledger/forward"))
    assert {r["key"]: r["attempts"] for r in forward.collect() if r["status"] == "api_failure"} == {9: 3, 10: 3}
    assert forward.where("key >= 13").count() == 0


def test_resume_calls_only_for_new_rows_and_reports_all(spark, tmp_path):
    first = judged(spark, tmp_path / "ledger", CASES[:3])
    assert P.judge_summary(first).first()["total"] == 3

    def refusing():
        def judge(request):
            raise AssertionError("asked again")
        return judge

    again = judged(spark, tmp_path / "ledger", CASES[:3], refusing)
    assert P.judge_summary(again).first()["kept"] == 2
    full = P.judge_summary(judged(spark, tmp_path / "ledger")).first()
    assert full.asDict() == {
        "total": 16, "kept": 2, "position_bias_disagreement": 2, "parse_failure": 6, "api_failure": 3,
        "degenerate_pair": 3, "not_judged": 0, "mean_length_ratio": pytest.approx((6 / 8 + 8 / 6) / 2),
    }


def test_a_failure_after_some_calls_loses_one_part_at_most(spark, tmp_path):
    """The judge breaks for good at one pair; what was committed before is not asked about again."""
    calls = tmp_path / "calls"
    calls.mkdir()

    def counting(broken):
        def factory():
            judge = first_word_judge()

            def answer(request):
                (calls / uuid.uuid4().hex).write_text(request)
                if broken and "slow answer" in request:
                    raise KeyboardInterrupt
                return judge(request)

            return answer

        return factory

    pairs = [(f"A B {i}", f"a{i}", f"b{i} slow answer" if i == 11 else f"b{i} longer") for i in range(12)]
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "key int, prompt string, completion_a string, completion_b string")
    options = {"rows_per_commit": 2, "retry_seconds": 0.0, "max_attempts": 1}
    with pytest.raises(Exception):
        P.judge_pairs(rows, counting(True), str(tmp_path / "ledger"), **options)
    done = {r.key for r in read_ledger(spark, f"{tmp_path}/ledger/forward", "key int").collect()}
    before = len(list(calls.iterdir()))
    assert 11 not in done and before
    P.judge_pairs(rows, counting(False), str(tmp_path / "ledger"), **options).collect()
    asked = [f.read_text() for f in calls.iterdir()]
    forward = [sum(f"<response_a>\na{i}\n" in a for a in asked) for i in range(12)]
    assert all(forward[i] == 1 for i in done) and sum(forward) <= 12 + 12 - len(done)


def test_both_orders_judge_the_same_answers(spark, tmp_path):
    """The pairs come from a plan that gives other answers each time it runs."""
    rows = spark.range(20).select(
        F.col("id").cast("int").alias("key"), F.lit("A B").alias("prompt"),
        F.concat(F.lit("one "), F.uuid()).alias("completion_a"), F.concat(F.lit("other "), F.uuid()).alias("completion_b"),
    )
    got = P.judge_pairs(rows, first_word_judge, str(tmp_path / "ledger"), retry_seconds=0.0)
    first, second = sorted(map(tuple, got.collect())), sorted(map(tuple, got.collect()))
    assert first == second and len(first) == 20


def test_summary_of_nothing_kept(spark, tmp_path):
    row = P.judge_summary(judged(spark, tmp_path / "ledger", CASES[13:])).first()
    assert row["kept"] == 0 and row["mean_length_ratio"] is None and row["degenerate_pair"] == 3


def test_bias_report(spark, tmp_path):
    rows = {r["order"]: r for r in P.judge_bias(judged(spark, tmp_path / "ledger", CASES[:4])).collect()}
    assert rows["forward"]["a_rate"] == 0.5 and rows["forward"]["agreement"] == 0.5


def test_retry_recovers_and_gives_up():
    answers = [RuntimeError("no answer"), verdict("B")]

    def flaky(_):
        answer = answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    assert P.ask(flaky, "r", 3, 0.0)["verdict"] == "B"
    answers[:] = [RuntimeError("no answer")] * 3
    assert P.ask(flaky, "r", 3, 0.0)["status"] == "api_failure" and not answers
    answers[:] = ["not json", verdict("A")]
    assert P.ask(flaky, "r", 3, 0.0)["status"] == "parse_failure" and len(answers) == 1


def test_self_check(spark):
    P.self_check(spark, lambda: lambda _: verdict("A"), retry_seconds=0.0)
    with pytest.raises(RuntimeError):
        P.self_check(spark, lambda: lambda _: "not json", retry_seconds=0.0)


def test_sampled_pairs(spark):
    df = spark.createDataFrame([(1, "hello"), (2, "bye")], "key int, prompt string")
    rows = {r["key"]: r for r in P.sample_pairs(df, stub_completer).collect()}
    assert rows[1]["completion_a"] == "<|user|>\nhello\n<|assistant|>\n"
    assert rows[2]["completion_b"] == "<|user|>\nbye\n<|assistant|>\n" * 2


@pytest.mark.parametrize("commits", [1, 3])
def test_generated_pairs_resume(spark, tmp_path, commits):
    path = str(tmp_path / "pairs")
    df = spark.createDataFrame([(1, "hello"), (2, "bye"), (3, "hi")], "key int, prompt string")
    P.generate_pairs(df.where("key = 1"), stub_completer, path)

    def loud():
        def complete(prompts, sample):
            return [ids + ids[-1:] for ids in prompts]
        return complete

    rows = {r["key"]: r["completion_a"] for r in P.generate_pairs(df, loud, path, commits=commits).collect()}
    assert rows == {1: "<|user|>\nhello\n<|assistant|>\n", 2: "\n", 3: "\n"}
    assert spark.read.parquet(path).count() == 3


def test_pending_ignores_input_order(spark, tmp_path):
    path = str(tmp_path / "done")
    rows = spark.range(10).withColumnRenamed("id", "key")
    assert pending(rows, path, "key").count() == 10
    metrics = append_ledger(rows.where("key < 4"), path, F.max("key").alias("top"))
    assert metrics == {"rows": 4, "top": 3}
    assert sorted(r["key"] for r in pending(rows.orderBy(F.desc("key")), path, "key").collect()) == [4, 5, 6, 7, 8, 9]
    assert read_ledger(spark, path, "key long").count() == 4


def test_preference_metrics(spark):
    df = spark.createDataFrame([(-1.0, -2.0, -1.5, -1.5), (-900.0, 0.0, 0.0, 0.0)],
                               "policy_chosen double, policy_rejected double, ref_chosen double, ref_rejected double")
    row = P.preference_metrics(df, 0.1).first()
    margins = [0.1, -90.0]
    assert row["accuracy"] == 0.5 and row["margin"] == pytest.approx(sum(margins) / 2)
    assert row["loss"] == pytest.approx(sum(math.log1p(math.exp(-m)) for m in margins) / 2)


def test_changed_answers_are_judged_anew(spark, tmp_path):
    """Verdicts of an earlier run hold for the answers they were given for, and for no others."""
    def shorter():
        def judge(request):
            first, second = (request.split(f"<response_{x}>")[1].split(f"</response_{x}>")[0] for x in "ab")
            return '{"verdict": "%s"}' % ("A" if len(first) <= len(second) else "B")

        return judge

    schema, ledger = "key int, prompt string, completion_a string, completion_b string", f"{tmp_path}/ledger"
    rows = [(i, f"question {i}", "tiny", "a much longer answer") for i in range(6)]
    P.judge_pairs(spark.createDataFrame(rows, schema), shorter, ledger, retry_seconds=0).collect()
    asked = read_ledger(spark, f"{ledger}/forward", "key int, request_id string").count()
    rows = [(k, p, b, a) if k < 2 else (k, p, a, b) for k, p, a, b in rows]
    again = P.judge_pairs(spark.createDataFrame(rows, schema), shorter, ledger, retry_seconds=0)
    assert {r.chosen for r in again.collect() if r.kept} <= {"tiny"}
    table = read_ledger(spark, f"{ledger}/forward", "key int, request_id string")
    assert (asked, table.count()) == (6, 8)
    kept = "key int, request_id string, status string, verdict string, content string, attempts int"
    compact_ledger(spark, f"{ledger}/forward", kept, "key", "request_id")
    third = P.judge_pairs(spark.createDataFrame(rows, schema), shorter, ledger, retry_seconds=0).collect()
    assert sorted(third) == sorted(again.collect())
    assert read_ledger(spark, f"{ledger}/forward", kept).count() == 8


def test_calls_in_flight_keep_their_places(spark, tmp_path):
    """Several calls of a task at a time, the later ones done first: every request is asked about once and keeps its answer."""
    calls = str(tmp_path)

    def slow_start():
        import os
        import time
        import uuid

        def judge(request):
            number = int(request.rsplit(" ", 1)[1])
            open(os.path.join(calls, f"{number}-{time.monotonic()}-{uuid.uuid4().hex}"), "w").close()
            time.sleep(0.2 if number % 8 == 0 else 0.02)
            return '{"verdict": "%s"}' % "AB"[number % 2]

        return judge

    asked = spark.createDataFrame([(i, f"request {i}") for i in range(32)], "key int, request string").coalesce(1)
    got = P.judge_stage(asked, slow_start, retry_seconds=0, in_flight=8).collect()
    assert [(r.key, r.verdict) for r in got] == [(i, "AB"[i % 2]) for i in range(32)]
    numbers = [int(name.split("-")[0]) for name in os.listdir(calls)]
    assert sorted(numbers) == list(range(32))
    assert sorted(P.judge_stage(asked, slow_start, retry_seconds=0).collect()) == sorted(got)


def test_pauses_grow_by_the_backoff(monkeypatch):
    pauses = []
    monkeypatch.setattr(P.time, "sleep", pauses.append)

    def failing(request):
        raise OSError

    assert P.ask(failing, "r", 4, 2.0, 3.0)["status"] == "api_failure" and pauses == [2.0, 6.0, 18.0]
