"""Every registered query against its SQL over the same tables."""

import pytest
from compare import connect, differences

from tessera.plans.catalogue import ALL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


#: Tested against the public trainer instead.
WITHOUT_SQL = {"reference_vocabulary"}


def test_queries_without_sql_are_known():
    assert {name for name, (_, sql) in ALL.items() if sql is None} == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ALL.keys() - WITHOUT_SQL))
def test_query_equals_sql(spark, con, name):
    query, sql = ALL[name]
    assert differences(spark, con, query, sql, FOLDER) is None


@pytest.mark.parametrize("name", ["shuffle_order", "step_plan", "sft_examples", "seeded_draw", "judge_summary"])
@pytest.mark.parametrize("partitions", ["1", "7"])
def test_result_does_not_depend_on_partitions(spark, con, name, partitions):
    query, sql = ALL[name]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert differences(spark, con, query, sql, FOLDER) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
