from __future__ import annotations

import pytest
from tests.conftest import rows_of

from orderlens.operators import lookup


@pytest.fixture
def big(spark):
    return spark.createDataFrame([("hot", i) for i in range(20)] + [("b", 1), ("c", 2), (None, 3)], "k string, v int")


@pytest.fixture
def workspace(spark, tmp_path):
    with lookup.Workspace(spark, str(tmp_path)) as opened:
        yield opened
    assert not list(tmp_path.iterdir())


@pytest.fixture
def small(spark, workspace):
    return workspace.lookup(spark.createDataFrame([("hot", 1.5), ("b", None)], "k string, w double"))


def test_size_is_that_of_the_rows_as_text(small):
    assert small.text_bytes == len('{"k":"hot","w":1.5}') + len('{"k":"b"}')
    assert rows_of(small.table) == {("hot", 1.5), ("b", None)}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_both_ways_give_the_same_rows(big, small, how):
    broadcast, shuffled = (lookup.lookup_join(big, small, "k", how, max_bytes=limit) for limit in (10**6, 0))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (broadcast, shuffled)]
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
    assert "SortMergeJoin" in plans[1] and plans[1].count("Exchange hashpartitioning") == 2
    assert sorted(map(str, broadcast.collect())) == sorted(map(str, shuffled.collect()))


def test_stage_computes_once_and_lasts_until_the_workspace_closes(big, workspace, tmp_path):
    staged = workspace.stage(big)
    assert staged.schema == big.schema and rows_of(staged) == rows_of(big)
    assert str(tmp_path) in staged.inputFiles()[0]
    assert lookup.staged(big, None, "x") is big


def test_without_a_workspace_nothing_is_written(spark, big, tmp_path):
    table = spark.createDataFrame([("hot", 1.5), ("b", None)], "k string, w double")
    assert lookup.lookup_join(big, table, "k").count() == 21
    with lookup.Workspace(spark, str(tmp_path)) as opened:
        assert lookup.lookup_join(big, table, "k", workspace=opened).count() == 21


def test_empty_lookup(spark, big, workspace):
    empty = workspace.lookup(spark.createDataFrame([], "k string, w double"))
    assert empty.text_bytes == 0
    assert lookup.lookup_join(big, empty, "k").count() == 0


def test_a_hot_key_is_split_beyond_the_broadcast_size(spark, small):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        big = spark.range(0, 60_000, 1, 8).selectExpr(
            "if(id % 3 = 0, 'hot', concat('k', id)) k", "concat('a value of some length ', id) v"
        )
        counts = lookup.lookup_join(big, small, "k", "left", max_bytes=0).groupBy("v").count()
        total = counts.agg({"count": "sum"})
        assert total.collect()[0][0] == 60_000
        assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
