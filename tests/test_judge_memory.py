"""A judging task passes answers on before it has asked about its whole batch."""

from pyspark.sql import functions as F

from tessera.operators.pairs import judge_stage


def test_answers_are_passed_on_in_parts(spark):
    asked = spark.range(1_000, numPartitions=1).select(F.col("id").alias("key"), F.lit("r").alias("request"))

    def counting():
        calls = []

        def judge(request):
            calls.append(request)
            return f'{{"verdict": "A", "call": {len(calls)}}}'

        return judge

    # The calls made before a row is passed on, from the stage's function itself.
    batches = iter([asked.select("key", "request").toArrow().to_batches()[0]])
    stage = judge_stage(asked, counting, retry_seconds=0)
    first = next(iter(_function(judge_stage, asked, counting)(batches)))
    assert len(first) < 1_000
    rows = stage.orderBy("key").collect()
    assert [(r["key"], r["status"], r["attempts"]) for r in rows] == [(i, "ok", 1) for i in range(1_000)]
    assert rows[999]["content"] == '{"verdict": "A", "call": 1000}'


def _function(stage, asked, factory):
    """What the stage runs in its tasks."""
    held = {}

    class Frame:
        schema, columns = asked.schema, asked.columns

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            held["run"] = run

        mapInPandas = mapInArrow

    stage(Frame(), factory, retry_seconds=0)
    return held["run"]
