"""Column expressions. All are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata import names

INFINITY = float("inf")


def finite_or_null(value: Column) -> Column:
    """The value, or null where it is NaN or infinite.

    Spark orders NaN above infinity, so one comparison removes both.
    """
    return F.when(F.abs(value) < F.lit(INFINITY), value)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating column (done once, at bronze)."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floating:
        return df
    return df.withColumns({c: F.expr(f"nullif(`{c}`, double('NaN'))") for c in floating})


def _divide(a: Column, b: Column) -> Column:
    """IEEE division: x/0 is a signed infinity and 0/0 is missing; never raises."""
    return (
        F.when(b != 0, F.try_divide(a, b))
        .when(a > 0, F.lit(INFINITY))
        .when(a < 0, F.lit(-INFINITY))
    )


def ratio_fill_zero(a: Column, b: Column) -> Column:
    """a / b with *one* missing side taken as 0; both missing gives missing."""
    zero = F.lit(0.0)
    return F.when(
        a.isNotNull() | b.isNotNull(), _divide(F.coalesce(a, zero), F.coalesce(b, zero))
    ).cast("double")


def ratio_plain(a: Column, b: Column) -> Column:
    """a / b, missing when either side is missing."""
    return F.when(a.isNotNull() & b.isNotNull(), _divide(a, b)).cast("double")


def round_scaled(value: Column, digits: int, half_up: bool = False) -> Column:
    """Round to ``digits`` decimals.

    The default rounds the scaled double half-to-even, which is what array
    libraries do; ``half_up=True`` is SQL ``round``.
    """
    if half_up:
        return F.round(value, digits)
    power = F.lit(float(10**digits))
    return F.rint(value * power) / power


def completeness(*values: Column) -> Column:
    """``complete`` when every value is present and non-zero, else ``incomplete``."""
    filled = F.lit(True)
    for value in values:
        filled = filled & (F.coalesce(value, F.lit(0.0)) != 0)
    return F.when(filled, names.COMPLETE).otherwise(names.INCOMPLETE)


def days_to_timestamp(df: DataFrame, column: str) -> DataFrame:
    """Turn a floating days-since-1970 column into a timestamp, keeping day fractions.

    Absent columns and columns of any other type are left alone. The arithmetic
    is done without a time zone, so the session time zone has no say in it.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    if not isinstance(kinds.get(column), (T.DoubleType, T.FloatType)):
        return df
    moment = (
        "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
        f" + make_dt_interval(0, 0, 0, cast(`{column}` * 86400 AS decimal(18,6)))"
    )
    return df.withColumn(column, F.expr(moment))


def text_to_timestamp(df: DataFrame, column: str) -> DataFrame:
    """Turn a text column of dates, timestamps or days since 1970 into timestamps; other text is an error.

    Columns of any other type are left alone.
    """
    if not isinstance(df.schema[column].dataType, T.StringType):
        return df
    text = F.trim(F.col(f"`{column}`"))
    moment = F.coalesce(text.try_cast("timestamp_ntz"), F.expr(f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(try_cast(trim(`{column}`) AS double) * 86400 AS decimal(18,6)))"))
    message = F.concat(F.lit(f"column {column}: no point in time: "), text)
    return df.withColumn(column, F.when(text.isNotNull() & moment.isNull(), F.raise_error(message).cast("timestamp_ntz")).otherwise(moment))


def key_text(df: DataFrame, column: str) -> Column:
    """A territory key as text; numbers without their fraction, which only says how they were stored."""
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        value = value.cast("bigint")
    return value.cast("string")


def _converted(df: DataFrame, column: str, to: str) -> Column:
    """The value in another type, null if it does not convert. Text such as ``10.0`` is a whole number."""
    value = F.col(f"`{column}`")
    if to != "bigint" or not isinstance(df.schema[column].dataType, T.StringType):
        return value.try_cast(to)
    number = value.try_cast("double")
    return F.coalesce(value.try_cast(to), F.when(number == F.floor(number), number.try_cast(to)))


def cast_strict(df: DataFrame, column: str, to: str) -> DataFrame:
    """Cast; a value that does not convert fails the job, with or without ANSI mode."""
    if df.schema[column].dataType.simpleString() == to:
        return df
    value = F.col(f"`{column}`")
    converted = _converted(df, column, to)
    bad = value.isNotNull() & converted.isNull()
    message = F.concat(F.lit(f"column {column}: cannot cast to {to}: "), value.cast("string"))
    return df.withColumn(column, F.when(bad, F.raise_error(message).cast(to)).otherwise(converted))


def cast_coerce(df: DataFrame, column: str, to: str) -> DataFrame:
    """Cast; a value that does not convert becomes null."""
    return df.withColumn(column, _converted(df, column, to))


def cast_ignore(df: DataFrame, column: str, to: str) -> DataFrame:
    """Cast the column if every value converts, else leave the whole column as it is.

    Integral columns always convert to a wider number, so only other types cost
    a pass (one aggregate, one row back).
    """
    value = F.col(f"`{column}`")
    kind = df.schema[column].dataType
    if not (isinstance(kind, (T.IntegralType, T.DoubleType)) and to == "double" or kind.simpleString() == to):
        counts = df.agg(F.count(value).alias("given"), F.count(_converted(df, column, to)).alias("usable"))
        given, usable = counts.first()
        if given != usable:
            return df
    return cast_coerce(df, column, to)


CAST_MODES = {
    "strict": cast_strict,
    "coerce": cast_coerce,
    "ignore": cast_ignore,
    "none": lambda df, column, to: df,
}
