import datetime as dt
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tradewind.functions.calendar import month_distance, month_label, month_of
from tradewind.operators.joins import join_counted
from tradewind.operators.lineage import written
from tradewind.session import clear_scratch, shared_dir, shuffle_tasks


def test_scratch_is_shared_and_cleared(spark):
    df = written(spark.range(10), "test")
    (path,) = {Path(f.removeprefix("file://")).parent for f in df.inputFiles()}
    assert str(path).startswith(shared_dir(spark)) and df.count() == 10
    clear_scratch(spark)
    assert not path.exists()


def session_stub(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder or default),
        sparkContext=SimpleNamespace(master=master))


def test_shared_folder_comes_from_the_session():
    assert shared_dir(session_stub("yarn", "hdfs://cluster/shared/")) == "hdfs://cluster/shared"
    own = shared_dir(session_stub("local[8]"))
    assert Path(own).is_dir() and own == shared_dir(session_stub("local[2]"))
    with pytest.raises(RuntimeError):
        shared_dir(session_stub("spark://host:7077"))


def test_shuffle_tasks_follow_the_session(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert shuffle_tasks(spark) == 8
    spark.conf.set(key, "24")
    try:
        assert shuffle_tasks(spark) == 24
    finally:
        spark.conf.unset(key)


@pytest.mark.parametrize("how, expected", [("inner", 5), ("left_semi", 5), ("left", 10)])
def test_counted_join_gives_the_same_rows_either_way(spark, capsys, how, expected):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big, narrow = spark.range(10), spark.range(5)
        small = join_counted(big, narrow, "id", how)
        large = join_counted(big, narrow, "id", how, rows=10**9)
        assert small.count() == large.count() == expected
        small.explain()
        assert "BroadcastHashJoin" in capsys.readouterr().out
        large.explain()
        assert "SortMergeJoin" in capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_months(spark):
    row = spark.range(1).select(
        month_of(F.lit(dt.datetime(2025, 12, 31, 23, 59))).alias("m"),
        month_label(F.lit(dt.date(2025, 12, 1))).alias("label"),
        month_distance(F.lit(dt.date(2026, 3, 1)), F.lit(dt.date(2025, 12, 1))).alias("d")).first()
    assert (row.m, row.label, row.d) == (dt.date(2025, 12, 1), "2025-12", 3)
