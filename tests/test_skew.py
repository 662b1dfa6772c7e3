"""Hot keys of the overlap are split when the joins run."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradewind.operators.lineage import written
from tradewind.operators.overlap import CELL, _sliced

MAP_TASKS = 8
SMALL_PARTS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def small_parts(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL_PARTS}
    for key, value in SMALL_PARTS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("hot", ["product_id", "customer_id"])
def test_hot_key_is_split(spark, small_parts, hot):
    """Half of all pairs have one product, or one customer."""
    other = "customer_id" if hot == "product_id" else "product_id"
    pairs = written(
        spark.range(200_000).select(
            F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 5_000 + 1).alias(hot), F.xxhash64("id").alias(other))
        .repartition(MAP_TASKS), "pairs")
    sliced = _sliced(pairs, CELL).withColumn("task", F.spark_partition_id())
    rows = sliced.collect()
    assert "skew=true" in sliced._jdf.queryExecution().executedPlan().toString()
    tasks = Counter(row["task"] for row in rows).values()
    assert len(rows) == 200_000
    # Skew is split between map outputs, so the hot key's 100,000 rows can be cut into as many parts as there are.
    assert max(tasks) < 2 * 100_000 / MAP_TASKS
