"""The JSON wire format of sale messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow import schemas

CORRUPT = "_corrupt"


def encode(df: DataFrame) -> DataFrame:
    """One JSON object per row in column ``value``; null fields are left out."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def as_text(df: DataFrame, column: str = "value") -> DataFrame:
    """The message body as text; buses deliver it as bytes."""
    return df.withColumn(column, F.col(column).cast("string"))


def _parsed(df: DataFrame, schema: T.StructType, column: str, *keep: Column) -> DataFrame:
    """One row per message: ``keep``, the fields of ``schema`` and the corrupt text.

    Expanding the parsed struct as rows makes it a plan node of its own: each
    message is parsed once, whatever is filtered and selected afterwards.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    struct = F.from_json(F.col(column), with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    return df.select(*keep, F.inline(F.array(struct)))


def _unreadable(schema: T.StructType, is_message: Column) -> Column:
    nothing = F.coalesce(*[F.col(n).cast("string") for n in schema.names]).isNull()
    return ~is_message | (F.col(CORRUPT).isNotNull() & nothing)


def decode(df: DataFrame, schema: T.StructType = schemas.WIRE,
           column: str = "value") -> DataFrame:
    """Typed columns from JSON text.

    Keys that are absent become null columns, undeclared keys are ignored, a
    field of the wrong type is null in that field only. Rows from which nothing
    could be read (malformed text) are left out: see :func:`quarantine`.
    """
    messages = df.filter(F.col(column).isNotNull())
    return (
        _parsed(messages, schema, column)
        .filter(~_unreadable(schema, F.lit(True))).select(*schema.names)
    )


def quarantine(df: DataFrame, schema: T.StructType = schemas.WIRE,
               column: str = "value") -> DataFrame:
    """Messages that were not fully readable, and whether their row was dropped."""
    source = F.col(column).alias("_message")
    is_message = F.col("_message").isNotNull()
    return (
        _parsed(df, schema, column, source)
        .filter(~is_message | F.col(CORRUPT).isNotNull())
        .select(F.col("_message").alias("value"),
                _unreadable(schema, is_message).alias("dropped"))
    )


MESSAGE = "_message"


def parse(df: DataFrame, schema: T.StructType = schemas.WIRE, column: str = "value") -> DataFrame:
    """Every message once: its text, its fields, and the corrupt text; the other columns stay.

    :func:`readable` and :func:`refused` are the two sides of it.
    """
    others = [F.col(c) for c in df.columns if c != column]
    return _parsed(df, schema, column, F.col(column).alias(MESSAGE), *others)


def readable(parsed: DataFrame, schema: T.StructType = schemas.WIRE) -> DataFrame:
    """The rows of :func:`parse` from which something could be read; the message text is left out."""
    return parsed.filter(~_unreadable(schema, F.col(MESSAGE).isNotNull())).drop(MESSAGE, CORRUPT)


def refused(parsed: DataFrame, schema: T.StructType = schemas.WIRE) -> DataFrame:
    """The messages of :func:`parse` that were not fully readable: value, dropped, and the other columns."""
    is_message = F.col(MESSAGE).isNotNull()
    return (
        parsed.filter(~is_message | F.col(CORRUPT).isNotNull())
        .withColumn("dropped", _unreadable(schema, is_message))
        .withColumnRenamed(MESSAGE, "value").drop(CORRUPT, *schema.names)
    )
