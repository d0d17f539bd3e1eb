"""All table and message schemas, in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LONG, _DOUBLE, _STRING = T.LongType(), T.DoubleType(), T.StringType()
_DATE, _NTZ = T.DateType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


SALE = _struct(
    serial_number=_LONG, list_year=_LONG, date_recorded=_DATE, town=_STRING, address=_STRING,
    assessed_value=_DOUBLE, sale_amount=_DOUBLE, sales_ratio=_DOUBLE, property_type=_STRING,
    residential_type=_STRING, non_use_code=_STRING, assessor_remarks=_STRING,
    opm_remarks=_STRING, location=_STRING,
)

# Header of the raw file, in file order (fixed values).
RAW_HEADER = [
    "Serial Number", "List Year", "Date Recorded", "Town", "Address", "Assessed Value",
    "Sale Amount", "Sales Ratio", "Property Type", "Residential Type", "Non Use Code",
    "Assessor Remarks", "OPM remarks", "Location",
]

# The raw file as read: dates stay text until they are parsed.
RAW = T.StructType([
    T.StructField(header, _STRING if field.dataType == _DATE else field.dataType, True)
    for header, field in zip(RAW_HEADER, SALE.fields)
])


def texts(schema: T.StructType) -> T.StructType:
    """The same columns as text."""
    return T.StructType([T.StructField(n, _STRING, True) for n in schema.names])


# A message on the bus: the sale with its date as ISO text.
WIRE = T.StructType([
    T.StructField(f.name, _STRING if f.dataType == _DATE else f.dataType, True) for f in SALE.fields
])

LAKE = T.StructType(SALE.fields + [T.StructField("created_at", _NTZ, True)])

# A message that could not be read in full; ``dropped``: nothing of it is in the lake.
QUARANTINE = _struct(value=_STRING, dropped=T.BooleanType(), created_at=_NTZ)

BATCH_BY_PROPERTY_TYPE = _struct(
    property_type=_STRING, total_customer=_LONG, started_at=_NTZ, ended_at=_NTZ)
BATCH_BY_TOWN = _struct(town=_STRING, total_customer=_LONG, started_at=_NTZ, ended_at=_NTZ)
BATCH_TOTALS = _struct(
    total_sales_ratio=_DOUBLE, total_sale_amount=_DOUBLE, total_customer=_LONG,
    started_at=_NTZ, ended_at=_NTZ)

SPEED_BY_PROPERTY_TYPE = _struct(property_type=_STRING, total_customer=_LONG, created_at=_NTZ)
SPEED_BY_TOWN = _struct(town=_STRING, total_customer=_LONG, created_at=_NTZ)
SPEED_TOTALS = _struct(
    total_sales_ratio=_DOUBLE, total_sale_amount=_DOUBLE, total_customer=_LONG, created_at=_NTZ)

_PARTITIONS = [T.StructField("created_date", _DATE, True),
               T.StructField("stream", T.StringType(), True), T.StructField("batch_id", _LONG, True)]


def partitioned(schema: T.StructType) -> T.StructType:
    """``schema`` plus the partition columns of appended tables."""
    return T.StructType(schema.fields + _PARTITIONS)


class SchemaError(ValueError):
    """A frame does not fit the declared table schema."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the declared columns, order and types.

    A missing or an undeclared column is an error; types are cast (with ANSI
    casts, a value that does not fit is an error at run time, too).
    """
    wanted, given = set(schema.names), set(df.columns)
    if wanted != given:
        raise SchemaError(
            f"missing columns {sorted(wanted - given)}, undeclared columns {sorted(given - wanted)}")
    return df.select(*[
        df[f.name] if df.schema[f.name].dataType == f.dataType
        else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
