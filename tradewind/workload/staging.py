"""CSV folders derived from the benchmark tables, to exercise the loader on whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.session import clear_scratch, scratch_path
from tradewind.sources.infer import create_tables
from tradewind.sources.star import read_table

def as_text(df: DataFrame) -> DataFrame:
    """Every column cast to the text a CSV file would hold."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def write_csv(df: DataFrame, folder: str, table: str) -> None:
    as_text(df).write.csv(f"{folder}/{table}.csv", header=True, escape='"', emptyValue="")


def accounting(amount: Column) -> Column:
    """Negative amounts in parentheses, as ledgers print them and no number parser reads them."""
    money = amount.cast("decimal(18,2)")
    return F.when(money < 0, F.concat(F.lit("("), F.abs(money).cast("string"), F.lit(")"))).otherwise(
        money.cast("string"))


_databases: list[str] = []


def clear(spark: SparkSession) -> None:
    """Drop the databases made here, and delete all files of this process below the scratch folder."""
    while _databases:
        spark.sql(f"DROP DATABASE IF EXISTS {_databases.pop()} CASCADE")
    clear_scratch(spark)


def new_database(spark: SparkSession, schemas: dict[str, str]) -> str:
    """An empty database of typed tables below the shared scratch folder."""
    name = f"load_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    _databases.append(name)
    create_tables(spark, name, {t: T.StructType.fromDDL(ddl) for t, ddl in schemas.items()})
    return name


def orders_folder(spark: SparkSession, sf_dir: str) -> str:
    """The orders as a CSV folder."""
    folder = scratch_path(spark, "csv")
    write_csv(read_table(spark, sf_dir, "orders"), folder, "orders")
    return folder


def ledger_folder(spark: SparkSession, sf_dir: str, sign: int = 1) -> str:
    """The customers as a CSV folder, their balances times ``sign``, negative ones in parentheses."""
    folder = scratch_path(spark, "csv")
    customer = read_table(spark, sf_dir, "customer")
    write_csv(customer.withColumn("c_acctbal", accounting(F.col("c_acctbal") * sign)), folder, "customer")
    return folder


def doubtful_folder(spark: SparkSession, sf_dir: str) -> str:
    """The orders as a CSV folder, some with dates and amounts that only look like ones."""
    folder, key, day = scratch_path(spark, "csv"), F.col("o_orderkey"), F.col("o_orderdate").cast("string")
    dates = F.array(day, F.substr(day, F.lit(1), F.lit(4)), F.substr(day, F.lit(1), F.lit(7)), F.concat(day, F.lit(" garbage")),
                    F.concat(F.substr(day, F.lit(1), F.lit(10)), F.lit("Tfoo")), F.substr(day, F.lit(1), F.lit(10)),
                    F.concat(F.substr(day, F.lit(1), F.lit(10)), F.lit(" 25:00:00")))
    amounts = F.array(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("1e-13"), F.lit("1.0000000000000001e2"),
                      F.lit("1.5e2"), F.lit("1200e-2"))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.get(dates, (key % 7).cast("int")).alias("o_orderdate"),
        F.get(amounts, (key % 5).cast("int")).alias("o_totalprice"))
    write_csv(orders, folder, "orders")
    return folder


def text_folder(spark: SparkSession, sf_dir: str) -> str:
    """The documents as a CSV folder: long text with quotes, commas and line breaks, some cells empty."""
    folder, key = scratch_path(spark, "csv"), F.col("doc_id")
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.when(key % 11 != 0, F.col("lang")).alias("lang"),
        F.concat(F.lit('say "'), F.col("text"), F.lit('", then\nstop')).alias("text"), "n_chars")
    write_csv(docs, folder, "documents")
    return folder


def ragged_folder(spark: SparkSession, sf_dir: str) -> str:
    """The suppliers as CSV lines, some cut short and some with cells too many."""
    folder, key = scratch_path(spark, "csv"), F.col("s_suppkey")
    supplier = read_table(spark, sf_dir, "supplier")
    line = F.when(key % 3 == 0, F.concat_ws(",", key.cast("string"), F.col("s_name"))).when(
        key % 3 == 1, F.concat_ws(",", key.cast("string"), F.col("s_name"), F.col("s_nationkey").cast("string"), F.lit("more"), F.lit("")),
    ).otherwise(F.concat_ws(",", key.cast("string"), F.lit(""), F.col("s_nationkey").cast("string")))
    # One column of whole lines, whose name is the header.
    supplier.select(line.alias("s_suppkey,s_name,s_nationkey")).write.csv(
        f"{folder}/supplier.csv", header=True, sep="\x01", quote="")
    return folder


def mixed_folder(spark: SparkSession, sf_dir: str) -> str:
    """Five tables: clean, with an unknown column, with bad values, and without a target table."""
    folder = ledger_folder(spark, sf_dir)
    nation = read_table(spark, sf_dir, "nation")
    write_csv(nation.withColumn("Observação", F.col("n_name")), folder, "nation")
    for table in ("lineitem", "orders", "supplier"):
        write_csv(read_table(spark, sf_dir, table), folder, table)
    return folder


TARGETS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal decimal(18,2),"
                " c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
                " l_quantity decimal(18,4), l_extendedprice decimal(18,2), l_discount decimal(18,4),"
                " l_tax decimal(18,4), l_returnflag string, l_linestatus string,"
                " l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int, n_comment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice decimal(18,2),"
              " o_orderdate timestamp_ntz, o_orderpriority string",
}
