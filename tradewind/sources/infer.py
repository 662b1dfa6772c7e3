"""Schema inference: one distributed aggregation for all sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.cells import (
    TYPE_RANK, fraction_digits, integer_digits, stripped, type_rank,
)
from tradewind.functions.names import normalize_header
from tradewind.sources.csv_files import for_each_source, list_csv, scan_csv, table_name, write_text

# Sources whose types are told by one job.
SOURCES_PER_JOB = 32
MAX_PRECISION = 38
# Decimals up to this precision are stored as a long.
COMPACT_PRECISION = 18


def _met(sources: list[DataFrame]) -> DataFrame:
    """All rows. Those of sources that few tasks read (files that are not cut) are dealt to all cores: telling the type of a
    cell costs far more than moving it. Sources with enough splits stay where they are."""
    tasks = sources[0].sparkSession.sparkContext.defaultParallelism
    few = [2 * rows.rdd.getNumPartitions() <= tasks for rows in sources]
    parts = [rows for rows, is_few in zip(sources, few) if not is_few]
    if any(few):
        # By number, as rows dealt in turn are sorted first.
        rows = reduce(DataFrame.unionByName, [rows for rows, is_few in zip(sources, few) if is_few])
        parts.append(rows.withColumn("at", F.monotonically_increasing_id()).repartition(tasks, "at").drop("at"))
    return reduce(DataFrame.unionByName, parts)


def profile(sources: dict[str, DataFrame]) -> DataFrame:
    """``(source, position, seen, int_digits, frac_digits)`` per column of DataFrames of strings.

    ``seen`` has one bit per type rank found. The rows of all sources meet as arrays of cells and are unpivoted together, so one
    compact piece of code, compiled once, serves any number of sources and columns, in one job. It is aggregated on the
    map side: a task ships one row per column.
    """
    arrays = [
        rows.select(F.lit(source).alias("source"), F.array(*[F.col(f"`{name}`") for name in rows.columns]).alias("cells"))
        for source, rows in sources.items()]
    value = F.col("value")
    numeric = F.col("kind").isin(*[TYPE_RANK[t] for t in ("NUMERIC", "BIGINT", "INTEGER")])
    return (
        _met(arrays).select("source", F.posexplode("cells").alias("position", "cell"))
        .select("source", "position", stripped(F.col("cell")).alias("value"))
        .select("source", "position", "value", type_rank(value).alias("kind"))
        .groupBy("source", "position")
        .agg(
            F.bit_or(F.expr("shiftleft(1, kind)")).alias("seen"),
            F.max(F.when(numeric, integer_digits(value))).alias("int_digits"),
            F.max(F.when(numeric, fraction_digits(value))).alias("frac_digits"))
    )


def _only(seen: Column, *types: str) -> Column:
    allowed = sum(1 << TYPE_RANK[t] for t in types)
    return (seen.bitwiseAND(F.lit(allowed)) == seen) & (seen > 0)


def merged_type(seen: Column, lattice: str = "rank") -> Column:
    """Type of a column from the types of its cells; no cells mean TEXT.

    ``rank`` takes the lowest rank, whatever the mix: dates with timestamps become DATE, booleans
    with integers INTEGER. ``safe`` takes a type that holds every cell and TEXT where none does.
    """
    if lattice == "rank":
        found = [F.when(F.getbit(seen, F.lit(rank)) == 1, F.lit(name))
                 for name, rank in TYPE_RANK.items()]
        return F.coalesce(*found, F.lit("TEXT"))
    if lattice != "safe":
        raise ValueError(f"unknown lattice {lattice!r}")
    return (
        F.when(_only(seen, "BOOLEAN"), "BOOLEAN")
        .when(_only(seen, "INTEGER"), "INTEGER")
        .when(_only(seen, "INTEGER", "BIGINT"), "BIGINT")
        .when(_only(seen, "INTEGER", "BIGINT", "NUMERIC"), "NUMERIC")
        .when(_only(seen, "DATE"), "DATE")
        .when(_only(seen, "DATE", "TIMESTAMP"), "TIMESTAMP")
        .otherwise("TEXT")
    )


def column_types(sources: dict[str, DataFrame], names: dict[str, list[str]] | None = None,
                 lattice: str = "rank") -> DataFrame:
    """``(source, position, column_name, type, int_digits, frac_digits)``, one row per column of each source."""
    names = names or {source: normalize_header(rows.columns) for source, rows in sources.items()}
    spark = next(iter(sources.values())).sparkSession
    columns = spark.createDataFrame(
        [(source, position, name) for source, of in names.items() for position, name in enumerate(of)],
        "source string, position int, column_name string")
    return columns.join(profile(sources), ["source", "position"], "left").select(
        "source", "position", "column_name", merged_type(F.col("seen"), lattice).alias("type"), "int_digits", "frac_digits")


def _spark_type(kind: str, int_digits: int | None, frac_digits: int | None) -> T.DataType:
    if kind == "NUMERIC":
        scale = frac_digits or 0
        digits = max((int_digits or 0) + scale, 1)
        if digits > MAX_PRECISION:
            return T.StringType()  # no bounded decimal holds every cell exactly
        return T.DecimalType(max(digits, COMPACT_PRECISION), scale)
    return {
        "TEXT": T.StringType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampNTZType(),
        "BIGINT": T.LongType(), "INTEGER": T.IntegerType(), "BOOLEAN": T.BooleanType(),
    }[kind]


def infer_schemas(sources: dict[str, DataFrame], names: dict[str, list[str]] | None = None,
                  lattice: str = "rank") -> dict[str, T.StructType]:
    """The typed schemas of DataFrames of strings, some of them at a time in one job. Collects one row per column."""
    found: dict[str, T.StructType] = {}
    keys = list(sources)
    for start in range(0, len(keys), SOURCES_PER_JOB):
        some = {key: sources[key] for key in keys[start:start + SOURCES_PER_JOB]}
        rows = sorted(column_types(some, names and {key: names[key] for key in some}, lattice).collect())
        for key in some:
            found[key] = T.StructType([
                T.StructField(c.column_name, _spark_type(c.type, c.int_digits, c.frac_digits)) for c in rows if c.source == key])
    return found


def infer_schema(rows: DataFrame, names: list[str] | None = None,
                 lattice: str = "rank") -> T.StructType:
    """The typed schema of one DataFrame of strings."""
    return infer_schemas({"": rows}, names and {"": names}, lattice)[""]


def infer_directory(spark: SparkSession, folder: str, lattice: str = "rank",
                    multiline: bool | None = None) -> dict[str, T.StructType]:
    """Schemas of all CSV sources in a folder by table name; of sources with one name the last. Empty files are left out."""
    paths = list_csv(spark, folder)
    scans = {path: scan for path, scan in zip(paths, for_each_source(lambda p: scan_csv(spark, p, multiline), paths)) if scan}
    if not scans:
        return {}
    schemas = infer_schemas({p: s.rows for p, s in scans.items()}, {p: s.names for p, s in scans.items()}, lattice)
    return {table_name(path): schema for path, schema in schemas.items()}


def qualified(database: str, table: str) -> str:
    """Table name for SQL; quoted, because a file may be named like a keyword."""
    return f"`{database}`.`{table}`"


def create_table_sql(table: str, schema: T.StructType) -> str:
    """``CREATE TABLE IF NOT EXISTS`` statement for one schema."""
    columns = ",\n".join(f"    `{f.name}` {f.dataType.simpleString().upper()}" for f in schema)
    return f"CREATE TABLE IF NOT EXISTS {table} (\n{columns}\n) USING PARQUET"


def ddl_script(schemas: dict[str, T.StructType]) -> str:
    """All statements as one script."""
    return "".join(f"-- {table}\n{create_table_sql(table, schema)};\n\n"
                   for table, schema in schemas.items())


def infer_script(spark: SparkSession, folder: str, path: str, lattice: str = "rank",
                 multiline: bool | None = None) -> dict[str, T.StructType]:
    """Infer a folder's schemas and write their statements as a script; returns the schemas."""
    schemas = infer_directory(spark, folder, lattice, multiline)
    write_text(spark, ddl_script(schemas), path)
    return schemas


def create_tables(spark: SparkSession, database: str, schemas: dict[str, T.StructType]) -> None:
    """Create every table that does not exist yet."""
    for table, schema in schemas.items():
        spark.sql(create_table_sql(qualified(database, table), schema))
