"""Cell classification, digits and conversion."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.cells import (
    TYPE_RANK, fraction_digits, integer_digits, stripped, type_rank, typed,
)

CASES = {
    "08450": "TEXT", "1234567890123": "TEXT", "123456789012": "BIGINT", "2147483647": "INTEGER",
    "2147483648": "BIGINT", "-2147483648": "INTEGER", "-3000000000": "BIGINT", "--5": "TEXT",
    "-5": "INTEGER", "+5": "TEXT", "0": "INTEGER", "-0": "INTEGER", "00": "TEXT", "1,5": "TEXT",
    "1e5": "TEXT", "1.0e5": "NUMERIC", "86.": "NUMERIC", ".5": "NUMERIC", "-.5": "NUMERIC",
    ".": "TEXT", "61..3": "TEXT", "nan": "TEXT", "inf": "TEXT", "sim": "BOOLEAN", "NAO": "BOOLEAN",
    "não": "TEXT", "T": "BOOLEAN", "yess": "TEXT", "2024-1-5": "DATE", "2024-02-30": "TEXT",
    "0000-01-01": "TEXT", "2024-01-05": "DATE", "2024-01-05 10:00:00": "TIMESTAMP",
    "2024-01-05 1:2:3": "TIMESTAMP", "2024-01-05 10:00:00.5": "TIMESTAMP",
    "2024-01-05 10:00:00.1234567": "TEXT", "2024-01-05 24:00:00": "TEXT",
    "2024-01-05 10:00": "TEXT", "2024-01-05T10:00:00": "TEXT", "24-01-05": "TEXT",
    "  42 ": "INTEGER", " 42 ": "INTEGER", "\x1c42": "INTEGER", "4 2": "TEXT",
    "": None, "   ": None, "　": None, "N/A": "TEXT", "?": "TEXT", "-": "TEXT",
}


def test_classification(spark):
    df = spark.createDataFrame([(c,) for c in CASES], "cell string")
    value = stripped(F.col("cell"))
    got = {r.cell: r.rank for r in df.select("cell", type_rank(value).alias("rank")).collect()}
    assert got == {c: None if t is None else TYPE_RANK[t] for c, t in CASES.items()}


@pytest.mark.parametrize("text, before, after", [
    ("1234.5", 4, 1), ("007.50", 1, 2), ("-0.001", 0, 3), ("86.", 2, 0), ("1.5e3", 4, 0),
    ("1.25e-2", 0, 4), ("42", 2, 0), ("+1.5E3", 4, 0),
])
def test_digits(spark, text, before, after):
    v = F.lit(text)
    row = spark.range(1).select(integer_digits(v).alias("i"), fraction_digits(v).alias("f")).first()
    assert (max(row.i, 0), row.f) == (before, after)


@pytest.mark.parametrize("text, ddl, value", [
    (" 7 ", "int", 7), ("7.5", "int", None), ("abc", "int", None), ("2147483648", "int", None),
    ("2147483648", "bigint", 2147483648), ("sim", "boolean", True), (" TRUE\t", "boolean", True), ("NAO", "boolean", False),
    ("on", "boolean", True), ("0", "boolean", False), ("maybe", "boolean", None),
    ("86.", "decimal(18,2)", Decimal("86.00")), ("1.005", "decimal(18,2)", None),
    ("1.500", "decimal(18,2)", Decimal("1.50")), ("1e2", "decimal(18,2)", Decimal("100.00")),
    ("1.5e-3", "decimal(18,2)", None), ("2024-1-5", "date", dt.date(2024, 1, 5)),
    ("2024-02-30", "date", None), (" kept ", "string", " kept "), ("", "int", None),
    ("12.3400", "decimal(18,2)", Decimal("12.34")), ("-.5", "decimal(18,2)", Decimal("-0.50")),
    (" 7.50\t", "decimal(18,2)", Decimal("7.50")), ("1e-5", "decimal(18,2)", None),
    ("1e-13", "decimal(18,2)", None), ("1.0000000000000001e2", "decimal(18,2)", None),
    ("1200e-2", "decimal(18,2)", Decimal("12.00")), ("0e-40", "decimal(18,2)", Decimal("0.00")),
    ("1e99999999999", "decimal(18,2)", None), ("12.50e0", "decimal(18,2)", Decimal("12.50")),
    ("2031", "date", None), ("2031-05", "date", None), ("2031-05-07 garbage", "date", None), ("2031-05-07Tfoo", "date", None),
    ("2031-05-07 10:11:12", "date", dt.date(2031, 5, 7)), (" 2031-05-07 ", "date", dt.date(2031, 5, 7)), ("2031-05-07 25:00:00", "date", None),
    ("2031", "timestamp_ntz", None), ("2031-05", "timestamp_ntz", None), ("2031-05-07 x", "timestamp_ntz", None),
    ("2031-05-07", "timestamp_ntz", dt.datetime(2031, 5, 7)), ("2031-05-07T09:08", "timestamp_ntz", dt.datetime(2031, 5, 7, 9, 8)),
    ("1.25E1", "decimal(18,2)", Decimal("12.50")), ("7 7", "int", None), (".", "decimal(18,2)", None),
    ("2024-01-05 10:00:00.5", "timestamp_ntz", dt.datetime(2024, 1, 5, 10, 0, 0, 500000)),
])
def test_conversion(spark, text, ddl, value):
    kind = T.StructType.fromDDL(f"x {ddl}")[0].dataType
    assert spark.createDataFrame([(text,)], "c string").select(typed(F.col("c"), kind)).first()[0] == value
