"""One query per job and operator, on the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.calendar import calendar_dim
from tradewind.functions.names import normalize_columns
from tradewind.operators.lineage import written
from tradewind.plans import customers, demand, orders, recommend, sales
from tradewind.sources import star
from tradewind.sources.csv_files import list_csv
from tradewind.sources.infer import column_types
from tradewind.sources.load import ingest_directory, load_csv, load_directory, read_typed_csv
from tradewind.sources.publish import recover_database
from tradewind.sources.query import read_query
from tradewind.sources.records import split_rows
from tradewind.workload import staging

Query = Callable[[SparkSession, str], DataFrame]
VALID = star.VALID_STATUS
INFERRED_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
# Headings for the part table: accents, punctuation, a leading digit and a repeated name.
PART_HEADINGS = ("Código da Peça", "Descrição", "Marca", "Marca", "2nd size", "Preço (R$)")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison with other engines."""
    return df.select(*[
        F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema])


def _chain(t: star.Retail) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return t.orders, t.order_items, t.product_variants, t.products


def _retail(job: Callable[[star.Retail], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(job(star.Retail(spark, sf_dir)))


def _bought(job: Callable[[DataFrame], DataFrame]) -> Query:
    return _retail(lambda t: job(recommend.purchases(*_chain(t), VALID)))


def _monthly(t: star.Retail) -> DataFrame:
    return demand.monthly_demand(*_chain(t), valid_status=VALID)


def _order_lines(t: star.Retail) -> DataFrame:
    return orders.order_lines(*_chain(t), VALID).select(
        "order_id", "customer_id", "product_id", F.col("category_id").alias("category"), "quantity")


def _similar(t: star.Retail) -> DataFrame:
    bought = recommend.purchases(*_chain(t), VALID)
    return recommend.similar_products(bought, t.products, star.PRODUCT_NAME)


def queried_pairs(t: star.Retail) -> DataFrame:
    """Who bought what, as a query over the tables instead of a job."""
    states = ", ".join(f"'{state}'" for state in VALID)
    return read_query(
        t.orders.sparkSession,
        f"""SELECT DISTINCT o.customer_id, p.id AS product_id, p.name AS product_name
            FROM {{orders}} o JOIN {{items}} i ON i.order_id = o.id JOIN {{variants}} v ON v.id = i.product_variant_id
            JOIN {{products}} p ON p.id = v.product_id WHERE o.status IN ({states})""",
        orders=t.orders, items=t.order_items, variants=t.product_variants, products=t.products)


def infer_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred types of the tables' columns, every cell taken as text."""
    tables = {table: staging.as_text(star.read_table(spark, sf_dir, table)) for table in INFERRED_TABLES}
    return column_types(tables).select(F.col("source").alias("table_name"), "column_name", "type")


def renamed_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table under headings that need normalising, normalised."""
    return normalize_columns(star.read_table(spark, sf_dir, "part").toDF(*PART_HEADINGS))


def loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV, their schema inferred, loaded into a typed table and read back."""
    database = staging.new_database(spark, {})
    ingest_directory(spark, staging.orders_folder(spark, sf_dir), database)
    loaded = spark.table(f"{database}.orders")
    keys = {c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")}
    return plain(loaded.withColumns(keys))


def rejected_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose balance does not parse, kept as text beside the loaded ones."""
    (path,) = list_csv(spark, staging.ledger_folder(spark, sf_dir))
    database = staging.new_database(spark, {"customer": staging.TARGETS["customer"]})
    load_csv(spark, path, database, on_error="quarantine")
    return spark.table(f"{database}.customer_rejects").withColumn(
        "bad_columns", F.array_join("bad_columns", ","))


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a folder of CSVs: loaded, rejected for bad values, without a target table."""
    folder = staging.mixed_folder(spark, sf_dir)
    audit = load_directory(spark, folder, staging.new_database(spark, staging.TARGETS))
    return audit.select(
        "table_name", "status", "rows_loaded", "rows_rejected",
        F.array_join("unmatched", ",").alias("unmatched"))


def bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with dates and amounts that only look like ones: kept apart, or refused as a whole."""
    (path,) = list_csv(spark, staging.doubtful_folder(spark, sf_dir))
    target = {"orders": "o_orderkey bigint, o_orderdate date, o_totalprice decimal(18,2)"}
    database = staging.new_database(spark, target)
    load_csv(spark, path, database, on_error="quarantine")
    loaded = spark.table(f"{database}.orders").select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.lit("loaded").alias("outcome"), F.lit("").alias("bad_columns"),
        F.col("o_orderdate").cast("string").alias("o_orderdate"), F.col("o_totalprice").cast("double").alias("o_totalprice"))
    nothing = (F.lit(None).cast("string").alias("o_orderdate"), F.lit(None).cast("double").alias("o_totalprice"))
    rejects = spark.table(f"{database}.orders_rejects").select(
        F.col("o_orderkey").cast("bigint"), F.lit("rejected"), F.array_join("bad_columns", ","), *nothing)
    audit = load_csv(spark, path, staging.new_database(spark, target), on_error="reject")
    refused = spark.range(1).select(
        F.lit(-1).cast("bigint"), F.lit(f"whole source {audit.status}"), F.lit(str(audit.rows_rejected)), *nothing)
    return loaded.union(rejects).union(refused)


def loaded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents through CSV and back: quotes, commas, line breaks and empty cells."""
    (path,) = list_csv(spark, staging.text_folder(spark, sf_dir))
    database = staging.new_database(spark, {"documents": "doc_id bigint, lang string, text string, n_chars bigint"})
    load_csv(spark, path, database)
    return spark.table(f"{database}.documents")


def interrupted_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and their rejects while a second load is committed but not shown, and after its recovery."""
    database = staging.new_database(spark, {"customer": staging.TARGETS["customer"]})

    def load(sign: int, publish: bool) -> None:
        (path,) = list_csv(spark, staging.ledger_folder(spark, sf_dir, sign))
        load_csv(spark, path, database, on_error="quarantine", publish=publish)

    def seen(moment: str) -> DataFrame:
        tables = {"loaded": "customer", "rejected": "customer_rejects"}
        rows = [spark.table(f"{database}.{table}").select(
            F.lit(moment).alias("moment"), F.lit(outcome).alias("outcome"), F.col("c_custkey").cast("long").alias("c_custkey"))
            for outcome, table in tables.items()]
        return written(reduce(DataFrame.unionByName, rows), "seen")  # the files change with the next load

    load(1, True)
    load(-1, False)
    before = seen("committed")
    recover_database(spark, database)
    return before.unionByName(seen("recovered"))


def split_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents through CSV, whose records go over line breaks, read in splits and put together again."""
    (path,) = list_csv(spark, staging.text_folder(spark, sf_dir))
    names = ["doc_id", "lang", "text", "n_chars"]
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    rows = split_rows(spark, path, names, names, True, options)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text", F.col("n_chars").cast("long").alias("n_chars"))


def ragged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers from lines with too few and too many cells, as typed rows."""
    (path,) = list_csv(spark, staging.ragged_folder(spark, sf_dir))
    return read_typed_csv(spark, path, T.StructType.fromDDL("s_suppkey bigint, s_name string, s_nationkey int"))


QUERIES: dict[str, Query] = {
    # orders
    "orders_overview": _retail(lambda t: orders.orders_overview(t.orders)),
    "row_count_total": _retail(lambda t: orders.row_count_total(
        t.customers, t.orders, t.order_items, t.payments)),
    "row_count_breakdown": _retail(lambda t: orders.row_count_breakdown(
        t.customers, t.orders, t.order_items, t.payments)),
    "valid_orders": _retail(lambda t: orders.valid_orders(t.orders, VALID).select(
        "id", "customer_id", "total")),
    "order_lines": _retail(_order_lines),
    # customers
    "customer_metrics": _retail(lambda t: customers.customer_metrics(t.orders, VALID)),
    "category_diversity": _retail(lambda t: customers.category_diversity(*_chain(t), VALID)),
    "elite_customers": _retail(lambda t: customers.elite_customers(*_chain(t), valid_status=VALID)),
    "elite_top_category": _retail(lambda t: customers.elite_top_category(
        *_chain(t), t.categories, valid_status=VALID)),
    # sales
    "calendar_dim": _retail(lambda t: calendar_dim(t.orders)),
    "daily_pos_sales": _retail(lambda t: sales.daily_sales(t.orders, star.CHANNEL, VALID)),
    "calendar_sales": _retail(lambda t: sales.calendar_sales(t.orders, star.CHANNEL, VALID)),
    "weekday_sales": _retail(lambda t: sales.weekday_sales(t.orders, star.CHANNEL, VALID)),
    # demand
    "product_lines": _retail(lambda t: demand.product_lines(
        t.order_items, t.product_variants, t.products, star.PRODUCT_NAME)),
    "monthly_demand": _retail(_monthly),
    "product_demand": _retail(lambda t: demand.monthly_demand(
        *_chain(t), product_name=star.PRODUCT_NAME, valid_status=VALID)),
    "ma_forecast": _retail(lambda t: demand.ma_forecast(_monthly(t), star.CUTOFF)),
    "forecast_eval": _retail(lambda t: demand.forecast_eval(_monthly(t), star.CUTOFF)),
    "forecast_metrics": _retail(lambda t: demand.forecast_metrics(_monthly(t), star.CUTOFF)),
    # recommendation
    "purchase_pairs": _bought(recommend.purchase_pairs),
    "purchase_pairs_query": _retail(queried_pairs),
    "product_names": _bought(recommend.product_names),
    "user_item_matrix": _bought(recommend.user_item_matrix),
    "matrix_shape": _bought(recommend.matrix_shape),
    "item_cosine": _bought(recommend.item_cosine),
    "similar_products": _retail(_similar),
    "similar_products_all": _bought(recommend.similar_products_all),
    # ingest
    "infer_schema": infer_tables,
    "normalize_columns": renamed_part,
    "csv_load": loaded_orders,
    "csv_rejects": rejected_customers,
    "csv_load_audit": load_audit,
    "csv_bad_values": bad_values,
    "csv_text_load": loaded_texts,
    "csv_interrupted_load": interrupted_load,
    "csv_split_records": split_texts,
    "csv_typed_scan": ragged_scan,
}
