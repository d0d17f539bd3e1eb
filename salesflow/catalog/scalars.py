"""Projections, predicates and scalar functions; lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow import schemas
from salesflow.catalog.base import (
    CUTOFF, DATE_TEXT, ENDED, NOW, STAMP, batch_of, date_text, month_cells, on_sales, on_views, query, speed_of)
from salesflow.functions import cleaning as C
from salesflow.functions.wire import as_text, decode, encode
from salesflow.operators.aggregates import count_by
from salesflow.operators.features import drop_columns, encode_by_mean
from salesflow.operators.serving import cutoff, since
from salesflow.session import stage
from salesflow.sources.files import slice_rows
from salesflow.sources.testdata import sales


@query("column_prune", on_sales("SELECT property_type, serial_number FROM sales"))
def column_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir, "property_type", "serial_number", "town", "sale_amount").select(
        "property_type", "serial_number")


@query("snake_case_columns", on_sales(
    "SELECT serial_number, list_year, sale_amount, opm_remarks FROM sales"))
def snake_case_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sales(spark, sf_dir, "serial_number", "list_year", "sale_amount", "opm_remarks").toDF(
        "Serial Number", "List Year", "Sale Amount", "OPM remarks")
    return C.snake_case(raw)


@query("fixed_rename", on_sales(
    'SELECT serial_number AS "SERIAL_NUMBER", list_year AS "LIST_YEAR", '
    'sale_amount AS "SALE_AMOUNT" FROM sales'))
def fixed_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.rename_to(sales(spark, sf_dir, "serial_number", "list_year", "sale_amount"),
                       ["SERIAL_NUMBER", "LIST_YEAR", "SALE_AMOUNT"])


def _date_texts(rows: DataFrame) -> DataFrame:
    """Dates as text in three shapes, by serial number: ISO, month first, empty."""
    kind = F.col("serial_number") % 3
    return rows.withColumn(
        "date_recorded",
        F.when(kind == 0, F.col("date_recorded").cast("string"))
        .when(kind == 1, F.date_format("date_recorded", "MM/dd/yyyy")).otherwise(""))


@query("type_cast", on_sales(
    "SELECT serial_number, CASE WHEN serial_number % 3 = 2 THEN NULL ELSE "
    "CAST(date_recorded AS VARCHAR) END AS date_recorded, sale_amount, list_year FROM sales"))
def type_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _date_texts(sales(spark, sf_dir, "serial_number", "date_recorded", "sale_amount",
                             "list_year"))
    texts = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    target = T.StructType([schemas.SALE[c] for c in texts.columns])
    return date_text(C.cast_sales(texts, target))


@query("blank_to_null", on_sales(
    "SELECT serial_number, nullif(property_type, '') AS property_type, "
    "nullif(assessor_remarks, '') AS assessor_remarks FROM sales"))
def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.blank_to_null(
        sales(spark, sf_dir, "serial_number", "property_type", "assessor_remarks"))


@query("fill_unknown", on_sales(
    "SELECT serial_number, coalesce(property_type, 'Unknown') AS property_type, "
    "coalesce(town, 'Unknown') AS town, sale_amount FROM sales"))
def fill_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.fill_unknown(sales(spark, sf_dir, "serial_number", "property_type", "town",
                                "sale_amount"))


@query("drop_incomplete", on_sales(
    "SELECT sale_amount, sales_ratio FROM sales WHERE sale_amount IS NOT NULL AND "
    "NOT isnan(sale_amount) AND sales_ratio IS NOT NULL AND NOT isnan(sales_ratio)"))
def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.drop_incomplete(sales(spark, sf_dir, "sale_amount", "sales_ratio"))


@query("missing_key_fill", on_sales(
    "SELECT serial_number, town, property_type, residential_type, non_use_code FROM sales"))
def missing_key_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    # null fields are absent from the messages, and some columns are never sent
    messages = encode(sales(spark, sf_dir, "serial_number", "town", "property_type",
                            "residential_type", heavy=True))
    return decode(messages).select(
        "serial_number", "town", "property_type", "residential_type", "non_use_code")


_SENT = [c for c in schemas.SALE.names]


@query("json_encode", on_sales(
    "SELECT serial_number, town, sale_amount, location, "
    + " + ".join(f"CAST({c} IS NOT NULL AS BIGINT)" for c in _SENT) + " AS keys FROM sales"))
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    read = ["serial_number", "town", "sale_amount", "location"]
    return encode(sales(spark, sf_dir, *_SENT, heavy=True)).select(
        F.json_tuple(value, *read).alias(*read),
        F.size(F.json_object_keys(value)).cast("long").alias("keys"),
    ).withColumns({"serial_number": F.col("serial_number").cast("long"),
                   "sale_amount": F.col("sale_amount").cast("double")})


@query("json_decode", on_sales(
    "SELECT serial_number, list_year, strftime(date_recorded, '%Y-%m-%d') AS date_recorded, town, "
    "address, assessed_value, sale_amount, CASE WHEN isnan(sales_ratio) THEN 'NaN' "
    "WHEN sales_ratio IS NOT NULL THEN 'number' END AS ratio_kind, property_type, "
    "residential_type, assessor_remarks, opm_remarks, location FROM sales"))
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(encode(sales(spark, sf_dir, *_SENT, heavy=True))).select(
        "serial_number", "list_year", "date_recorded", "town", "address", "assessed_value",
        "sale_amount", F.when(F.isnan("sales_ratio"), "NaN")
        .when(F.col("sales_ratio").isNotNull(), "number").alias("ratio_kind"), "property_type", "residential_type", "assessor_remarks",
        "opm_remarks", "location")


@query("bytes_to_text", on_sales("SELECT town, serial_number FROM sales"))
def bytes_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = encode(sales(spark, sf_dir, "serial_number", "town", "sale_amount", heavy=True))
    received = messages.select(F.col("value").cast("binary").alias("value"))
    partial = T.StructType([schemas.WIRE["town"], schemas.WIRE["serial_number"]])
    return decode(as_text(received), partial)


@query("parse_date", on_sales(
    "SELECT serial_number, CASE WHEN serial_number % 3 = 0 THEN CAST(date_recorded AS VARCHAR) "
    "END AS date_recorded FROM sales"))
def parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _date_texts(sales(spark, sf_dir, "serial_number", "date_recorded"))
    return date_text(rows.withColumn("date_recorded", C.parse_date(F.col("date_recorded"))))


@query("audit_columns", on_sales(
    f"SELECT coalesce(property_type, 'Unknown') AS property_type, count(*) AS total_customer, "
    f"TIMESTAMP '{CUTOFF}' AS started_at, TIMESTAMP '{ENDED}' AS ended_at, "
    f"TIMESTAMP '{STAMP}' AS created_at FROM sales GROUP BY 1"))
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = count_by(sales(spark, sf_dir, "property_type"), "property_type")
    return C.stamp(view, started_at=C.ntz(CUTOFF), ended_at=C.ntz(ENDED),
                   created_at=C.ntz(STAMP))


@query("open_range_filter", on_sales(
    "SELECT serial_number, sales_ratio FROM sales "
    "WHERE sales_ratio > 0.3 AND sales_ratio < 1.3 AND NOT isnan(sales_ratio)"))
def open_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.open_range(sales(spark, sf_dir, "serial_number", "sales_ratio"),
                        "sales_ratio", 0.3, 1.3)


@query("upper_bound_filter", on_sales(
    "SELECT serial_number, sale_amount FROM sales WHERE sale_amount < 50000"))
def upper_bound_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.below(sales(spark, sf_dir, "serial_number", "sale_amount"), "sale_amount", 50000)


@query("closed_time_window", on_sales(
    f"SELECT serial_number, created_at FROM sales "
    f"WHERE created_at >= TIMESTAMP '{CUTOFF}' AND created_at <= TIMESTAMP '{NOW}'"))
def closed_time_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.closed_window(sales(spark, sf_dir, "serial_number", "created_at"),
                           "created_at", C.ntz(CUTOFF), C.ntz(NOW))


@query("column_drop", on_sales("SELECT list_year, assessed_value, sale_amount FROM sales"))
def column_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_columns(sales(spark, sf_dir))


_ORDER = ["date_recorded", "serial_number", "sale_amount", "location"]


@query("row_slice", on_sales(
    f"SELECT {DATE_TEXT}, serial_number, sale_amount, location, position FROM ordered "
    "WHERE position >= n // 3 AND position < 2 * n // 3",
    ordered="SELECT date_recorded, serial_number, sale_amount, location, "
            "row_number() OVER (ORDER BY " + ", ".join(f"{c} NULLS FIRST" for c in _ORDER)
            + ") - 1 AS position, count(*) OVER () AS n FROM sales"))
def row_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(sales(spark, sf_dir, *_ORDER, heavy=True), "rows")
    n = rows.count()
    return date_text(slice_rows(rows, _ORDER, n // 3, 2 * n // 3))


@query("kpi_scale", on_sales(
    "SELECT list_year, round_even(sum(sale_amount) / 1e9, 2) AS billions, "
    "round_even(CAST(count(*) AS DOUBLE), 0) AS customers, "
    "round_even(avg(sales_ratio), 2) AS ratio FROM sales "
    "WHERE sale_amount IS NOT NULL AND sales_ratio IS NOT NULL AND NOT isnan(sales_ratio) "
    "GROUP BY list_year"))
def kpi_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.drop_incomplete(sales(spark, sf_dir, "list_year", "sale_amount", "sales_ratio"))
    return rows.groupBy("list_year").agg(
        C.scaled(F.sum("sale_amount"), 1e9, 2).alias("billions"),
        C.scaled(F.count(F.lit(1)).cast("double")).alias("customers"),
        C.scaled(F.avg("sales_ratio"), 1.0, 2).alias("ratio"))


@query("text_between", on_sales(
    "SELECT serial_number, regexp_extract(location, '\\((.*?) ', 1) AS first, "
    "CAST(len(regexp_extract_all(location, '\\((.*?) ', 1)) AS BIGINT) AS found FROM sales"))
def text_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = C.text_between(F.col("location"), r"\(", " ")
    return sales(spark, sf_dir, "serial_number", "location").select(
        "serial_number", F.get(found, F.lit(0)).alias("first"),
        F.size(found).cast("long").alias("found"))


@query("constant_column", on_sales(
    'SELECT serial_number, CAST(0 AS BIGINT) AS "CREATED_AT" FROM sales'))
def constant_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.constant(sales(spark, sf_dir, "serial_number"), "CREATED_AT", 0)
    return rows.withColumn("CREATED_AT", F.col("CREATED_AT").cast("long"))


@query("lookup_encode", on_sales(
    "SELECT serial_number, s.town, round(m, 4) AS town_mean FROM sales s LEFT JOIN "
    "(SELECT town, avg(sale_amount) AS m FROM sales WHERE town IS NOT NULL GROUP BY town) t "
    "ON s.town = t.town"))
def lookup_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    # two jobs read the rows: store them rather than join twice
    rows = stage(sales(spark, sf_dir, "serial_number", "town", "sale_amount"), "rows")
    return encode_by_mean(rows, "town", "sale_amount", "town_mean").select(
        "serial_number", "town", F.round("town_mean", 4).alias("town_mean"))


@query("cutoff_lookup", on_views(
    f"SELECT town, total_customer, created_at FROM speed_view "
    f"WHERE created_at >= (SELECT max(started_at) FROM batch_view) "
    f"AND created_at <= TIMESTAMP '{NOW}'", "town"))
def cutoff_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = month_cells(spark, sf_dir)
    return since(speed_of(cells, "town"), cutoff(batch_of(cells, "town")), C.ntz(NOW)).select(
        "town", "total_customer", "created_at")
