"""A query as a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_query(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """The result of a query over catalog tables, or over DataFrames given by name as ``{name}``."""
    return spark.sql(query, **tables)


def read_database_query(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """The result of a query run by an external database over JDBC.

    Pass ``dbtable`` with ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions``
    instead of a query to read a large table by parallel connections.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    return (reader if "dbtable" in options else reader.option("query", query)).load()
