"""Text cells: classification and typed conversion as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values ---------------------------------------------------------------------------------
# Column types, widest first: a column takes the lowest rank seen in its cells.
TYPE_RANK = {
    "TEXT": 0,
    "DATE": 1,
    "TIMESTAMP": 2,
    "NUMERIC": 3,
    "BIGINT": 4,
    "INTEGER": 5,
    "BOOLEAN": 6,
}
# Words that make a cell BOOLEAN.
BOOLEAN_WORDS = ("true", "false", "t", "f", "yes", "no", "sim", "nao")
# Spellings accepted when a BOOLEAN column is loaded: the database's input forms plus sim and nao.
TRUE_WORDS = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1", "sim")
FALSE_WORDS = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0", "nao")
INT_MIN, INT_MAX = -2147483648, 2147483647
# Characters stripped from both ends of a cell (Unicode white space and the four separators).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Whole numbers: no leading zero, and more than twelve digits are a code rather than a number.
INTEGER_SHAPE = r"^-?(0|[1-9][0-9]{0,11})$"
NUMERIC_SHAPE = r"^[+-]?([0-9]+[.][0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DATE_SHAPE = r"(?!0000)[0-9]{4}-(1[0-2]|0?[1-9])-(3[01]|[12][0-9]|0?[1-9])"
TIME_SHAPE = r"(2[0-3]|[01]?[0-9]):[0-5]?[0-9]:[0-5]?[0-9]([.][0-9]{1,6})?"
# Times accepted when a date or timestamp is loaded: seconds may be left out.
CLOCK_SHAPE = r"(2[0-3]|[01]?[0-9]):[0-5]?[0-9](:[0-5]?[0-9]([.][0-9]{1,6})?)?"
# ------------------------------------------------------------------------------------------------


def _visible(char: Column) -> Column:
    return F.ascii(char).between(ord("!"), ord("~"))


def stripped(cell: Column) -> Column:
    """The cell without white space at its ends; NULL when nothing is left.

    Trimming a set of characters is slow, so cells that start and end in a visible ASCII character,
    nearly all of them, are passed through.
    """
    bare = _visible(cell) & _visible(F.right(cell, F.lit(1)))
    return F.when(bare, cell).otherwise(F.nullif(F.btrim(cell, F.lit(WHITE_SPACE)), F.lit("")))


def type_rank(value: Column) -> Column:
    """Rank of a stripped cell's type; NULL casts no vote.

    Digit strings with a leading zero or more than twelve digits are codes, so TEXT; a number
    needs a decimal point to be NUMERIC; dates and timestamps must exist in the calendar. Cheap
    character tests come before patterns, and casts only see cells of the right shape: a failed
    cast costs far more than a pattern.
    """
    rank = {name: F.lit(code) for name, code in TYPE_RANK.items()}
    fits = value.try_cast("bigint").between(INT_MIN, INT_MAX)
    dated = F.substr(value, F.lit(5), F.lit(1)) == "-"
    numeric_start = F.ascii(value).between(ord("+"), ord("9"))
    return (
        F.when(value.isNull(), None)
        .when(~numeric_start,
              F.when(F.lower(value).isin(*BOOLEAN_WORDS), rank["BOOLEAN"]).otherwise(rank["TEXT"]))
        .when(value.rlike(INTEGER_SHAPE), F.when(fits, rank["INTEGER"]).otherwise(rank["BIGINT"]))
        .when(value.contains(".") & value.rlike(NUMERIC_SHAPE), rank["NUMERIC"])
        .when(dated & value.rlike(rf"^{DATE_SHAPE} {TIME_SHAPE}$")
              & value.try_cast("timestamp_ntz").isNotNull(), rank["TIMESTAMP"])
        .when(dated & value.rlike(rf"^{DATE_SHAPE}$") & value.try_cast("date").isNotNull(), rank["DATE"])
        .otherwise(rank["TEXT"])
    )


def _scientific(value: Column) -> Column:
    return value.contains("e") | value.contains("E")


def _moved(value: Column, written: Column, shift: int) -> Column:
    """Digits written on one side of the decimal point, moved by the exponent."""
    exponent = F.coalesce(F.regexp_extract(value, r"[eE](.*)$", 1).try_cast("int"), F.lit(0))
    return F.greatest(written + exponent * shift, F.lit(0))


def integer_digits(value: Column) -> Column:
    """Digits a whole or NUMERIC cell needs before the decimal point."""
    written = F.length(F.ltrim(F.substring_index(value, ".", 1), F.lit("+-0")))
    return F.when(_scientific(value), _moved(value, written, 1)).otherwise(written)


def fraction_digits(value: Column) -> Column:
    """Digits a whole or NUMERIC cell needs after the decimal point."""
    written = F.length(F.regexp_extract(value, r"[.]([0-9]*)", 1))
    return (
        F.when(~value.contains("."), 0)
        .when(_scientific(value), _moved(value, written, -1))
        .otherwise(F.length(value) - F.instr(value, "."))
    )


def _exact_scale(value: Column) -> Column:
    """Fraction digits that a number with an exponent needs, zeros at its end not counted."""
    mantissa = F.regexp_extract(value, r"^\s*[+-]?([0-9]*[.]?[0-9]*)[eE]", 1)
    exponent = F.regexp_extract(value, r"[eE]([+-]?[0-9]+)\s*$", 1).try_cast("int")
    digits = F.replace(mantissa, F.lit("."), F.lit(""))
    some = F.rtrim(digits, F.lit("0"))
    written = F.length(F.regexp_extract(mantissa, r"[.](.*)$", 1))
    return F.when(some == "", 0).otherwise(written - exponent - (F.length(digits) - F.length(some)))


def typed(cell: Column, to: T.DataType) -> Column:
    """A cell as ``to``; NULL when it is blank or has no exact value of that type.

    Text is kept verbatim. Casts ignore ASCII white space around a value. A number with more
    fraction digits than the target holds is not rounded silently but counts as unconvertible,
    unless the surplus digits are zeros. Dates need year, month and day; a time behind them must be
    one, and a date takes no part of it.
    """
    if isinstance(to, T.StringType):
        return cell
    if isinstance(to, T.BooleanType):
        word = F.lower(F.btrim(cell, F.lit(" \t\n\r\x0b\x0c")))
        return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
    value = cell.try_cast(to)
    if isinstance(to, T.DecimalType):
        plain = cell.rlike(rf"^\s*[+-]?[0-9]*([.][0-9]{{0,{to.scale}}}0*)?\s*$")
        return F.when(plain, value).when(_scientific(cell) & (_exact_scale(cell) <= to.scale), value)
    if isinstance(to, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.when(cell.rlike(rf"^\s*{DATE_SHAPE}([ T]{CLOCK_SHAPE})?\s*$"), value)
    return value
