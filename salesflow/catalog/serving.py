"""Serving: batch and speed views merged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.catalog.base import (
    NOW, batch_of, month_cells, month_totals, on_views, query, served_sql, speed_of)
from salesflow.functions.cleaning import ntz
from salesflow.operators.serving import serve_by_key, serve_totals, top_k, union_sum


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = month_totals(spark, sf_dir)
    return serve_totals(batch_of(cells), speed_of(cells), ntz(NOW))


def _merged_sql(figure: str) -> str:
    return on_views(f"""
SELECT {figure} FROM
  (SELECT * FROM batch_view ORDER BY ended_at DESC LIMIT 1) b,
  (SELECT coalesce(sum(total_sales_ratio), 0) AS r, coalesce(sum(total_sale_amount), 0) AS a,
          coalesce(sum(total_customer), 0) AS n FROM speed_view
   WHERE created_at >= (SELECT max(started_at) FROM batch_view)
     AND created_at <= TIMESTAMP '{NOW}') s""")


@query("serve_total_sale_amount", _merged_sql(
    "round(b.total_sale_amount + s.a, 2) AS total_sale_amount"))
def serve_total_sale_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).select(
        F.round("total_sale_amount", 2).alias("total_sale_amount"))


@query("serve_total_customer", _merged_sql(
    "CAST(b.total_customer + s.n AS BIGINT) AS total_customer"))
def serve_total_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).select("total_customer")


@query("serve_average_sale_ratio", _merged_sql(
    "round((b.total_sales_ratio + s.r) / (b.total_customer + s.n), 8) AS average_sale_ratio"))
def serve_average_sale_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).select(
        F.round("average_sale_ratio", 8).alias("average_sale_ratio"))


def _served(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    cells = month_cells(spark, sf_dir)
    return serve_by_key(batch_of(cells, key), speed_of(cells, key), key, ntz(NOW))


@query("serve_by_property_type", on_views(served_sql("property_type"), "property_type"))
def serve_by_property_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served(spark, sf_dir, "property_type")


@query("serve_by_town", on_views(served_sql("town"), "town"))
def serve_by_town(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served(spark, sf_dir, "town")


@query("top_towns", on_views(
    served_sql("town") + " ORDER BY total_customer DESC, town LIMIT 10", "town"))
def top_towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_served(spark, sf_dir, "town"), "total_customer", "town", 10)


@query("union_reaggregate", on_views(
    "SELECT property_type, CAST(sum(total_customer) AS BIGINT) AS total_customer FROM "
    "(SELECT property_type, total_customer FROM batch_view UNION ALL "
    "SELECT property_type, total_customer FROM speed_view) GROUP BY property_type",
    "property_type"))
def union_reaggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = month_cells(spark, sf_dir)
    return union_sum("property_type", batch_of(cells, "property_type"),
                     speed_of(cells, "property_type"))
