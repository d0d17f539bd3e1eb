"""Cleaning: names, types, blanks, incomplete rows, filters on ranges."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "Unknown"


def ntz(text: str) -> Column:
    """A timestamp literal without time zone; independent of the session zone."""
    return F.lit(text).cast("timestamp_ntz")


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def snake_case(df: DataFrame) -> DataFrame:
    """Column names in lower case with ``_`` for spaces."""
    return df.toDF(*[name.replace(" ", "_").lower() for name in df.columns])


def rename_to(df: DataFrame, header: Sequence[str]) -> DataFrame:
    """Rename all columns by position."""
    if len(header) != len(df.columns):
        raise ValueError(f"{len(header)} names for {len(df.columns)} columns")
    return df.toDF(*header)


def parse_date(text: Column) -> Column:
    """ISO text to date; anything else is null."""
    return text.try_cast("date")


def parse_date_any(text: Column) -> Column:
    """ISO or month/day/year text to date; anything else is null."""
    return F.coalesce(text.try_cast("date"), F.try_to_date(text, "MM/dd/yyyy"))


def cast_sales(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast same-named columns to ``schema``; text that does not parse becomes null."""
    def typed(field: T.StructField) -> Column:
        source, have = F.col(field.name), df.schema[field.name].dataType
        if have == field.dataType:
            return source
        if isinstance(field.dataType, T.DateType) and isinstance(have, T.StringType):
            return parse_date_any(source).alias(field.name)
        return source.try_cast(field.dataType).alias(field.name)

    return df.select(*[typed(f) for f in schema.fields])


def blank_to_null(df: DataFrame) -> DataFrame:
    """Exactly empty strings become null; blanks inside text are kept, nothing is trimmed."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in _strings(df)})


def fill_unknown(df: DataFrame, value: str = UNKNOWN) -> DataFrame:
    """Null strings become ``value``; numbers and empty strings are untouched."""
    return df.na.fill(value)


def is_complete(columns: Iterable[Column], numeric: bool = True) -> Column:
    """True where no column is null or (for floating point) NaN."""
    test = F.lit(True)
    for c in columns:
        test = test & c.isNotNull()
        if numeric:
            test = test & ~F.isnan(c)
    return test


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in the given columns (default: all)."""
    return df.na.drop(subset=list(columns) if columns else None)


def open_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """``low < column < high``. Null fails; so does NaN, which Spark orders above every number."""
    return df.filter((F.col(column) > low) & (F.col(column) < high))


def below(df: DataFrame, column: str, high: float) -> DataFrame:
    """``column < high``; null and NaN fail."""
    return df.filter(F.col(column) < high)


def closed_window(df: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    """``start <= column <= end``."""
    return df.filter(F.col(column).between(start, end))


def stamp(df: DataFrame, **columns: Column) -> DataFrame:
    """Add audit columns, for example ``started_at=ntz(..)``. No clock is read here."""
    return df.withColumns(columns)


def constant(df: DataFrame, name: str, value) -> DataFrame:
    """Add a constant column."""
    return df.withColumn(name, F.lit(value))


def text_between(text: Column, start: str, end: str) -> Column:
    """All shortest texts between two markers (regular expressions), as an array."""
    return F.regexp_extract_all(text, F.lit(f"{start}(.*?){end}"), F.lit(1))


def scaled(value: Column, divisor: float = 1.0, digits: int = 0) -> Column:
    """Divide and round half to even, for display figures."""
    return F.bround(value / F.lit(divisor), digits)
