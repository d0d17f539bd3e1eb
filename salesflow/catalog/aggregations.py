"""Aggregates, orders and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.catalog.base import (
    COMPLETE, CUTOFF, DATE_TEXT, ENDED, NOW, date_text, month_cells, month_totals, on_sales,
    on_views, query, speed_of)
from salesflow.functions.cleaning import drop_incomplete, ntz, stamp
from salesflow.operators import aggregates as A
from salesflow.operators.ordering import bounded_sample, preview, sort_by_date
from salesflow.operators.serving import (
    latest, view_sum_by_key_run, window_sum_by_key, window_totals)
from salesflow.session import work_dir
from salesflow.sources.testdata import sales, sales_files
from salesflow.sources.files import read_sales


def _by(key: str) -> str:
    return on_sales(
        f"SELECT coalesce({key}, 'Unknown') AS {key}, count(*) AS total_customer, "
        f"TIMESTAMP '{CUTOFF}' AS started_at, TIMESTAMP '{ENDED}' AS ended_at "
        f"FROM sales GROUP BY coalesce({key}, 'Unknown')")


@query("batch_count_by_property_type", _by("property_type"))
def batch_count_by_property_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = A.count_by(sales(spark, sf_dir, "property_type"), "property_type")
    return stamp(counts, started_at=ntz(CUTOFF), ended_at=ntz(ENDED))


@query("batch_count_by_town", _by("town"))
def batch_count_by_town(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = A.count_by(sales(spark, sf_dir, "town"), "town")
    return stamp(counts, started_at=ntz(CUTOFF), ended_at=ntz(ENDED))


@query("batch_totals", on_sales(
    f"SELECT round(sum(sales_ratio), 4) AS total_sales_ratio, "
    f"round(sum(sale_amount), 2) AS total_sale_amount, count(*) AS total_customer, "
    f"TIMESTAMP '{CUTOFF}' AS started_at, TIMESTAMP '{ENDED}' AS ended_at "
    f"FROM sales WHERE {COMPLETE}"))
def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = A.totals(sales(spark, sf_dir, "sales_ratio", "sale_amount"))
    return stamp(total, started_at=ntz(CUTOFF), ended_at=ntz(ENDED)).withColumns({
        "total_sales_ratio": F.round("total_sales_ratio", 4),
        "total_sale_amount": F.round("total_sale_amount", 2)})


@query("window_totals", on_views(
    f"SELECT round(coalesce(sum(total_sales_ratio), 0), 4) AS total_sales_ratio, "
    f"round(coalesce(sum(total_sale_amount), 0), 2) AS total_sale_amount, "
    f"CAST(coalesce(sum(total_customer), 0) AS BIGINT) AS total_customer FROM speed_view "
    f"WHERE created_at >= TIMESTAMP '{CUTOFF}' AND created_at <= TIMESTAMP '{NOW}'"))
def totals_of_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = speed_of(month_totals(spark, sf_dir))
    return window_totals(partials, ntz(CUTOFF), ntz(NOW)).select(
        F.round("total_sales_ratio", 4).alias("total_sales_ratio"),
        F.round("total_sale_amount", 2).alias("total_sale_amount"), "total_customer")


@query("window_sum_by_key", on_views(
    f"SELECT town, CAST(sum(total_customer) AS BIGINT) AS total_customer FROM speed_view "
    f"WHERE created_at >= TIMESTAMP '{CUTOFF}' AND created_at <= TIMESTAMP '{NOW}' "
    f"GROUP BY town", "town"))
def sum_by_key_of_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_sum_by_key(speed_of(month_cells(spark, sf_dir), "town"), "town",
                             ntz(CUTOFF), ntz(NOW))


# Three runs of the batch layer, by the cutoff of each.
_RUNS = ["1996-01-01 00:00:00", "1996-07-01 00:00:00", CUTOFF]
_RUNS_SQL = "SELECT unnest([" + ", ".join(f"TIMESTAMP '{r}'" for r in _RUNS) + "]) AS started_at"


def _runs(cells: DataFrame) -> DataFrame:
    """Every cell once per run that covers it."""
    covered = F.filter(F.array(*[ntz(r) for r in _RUNS]), lambda r: F.col("created_at") < r)
    return cells.withColumn("started_at", F.explode(covered))


@query("view_sum_by_key_run", on_sales(
    "SELECT coalesce(property_type, 'Unknown') AS property_type, started_at, "
    "count(*) AS total_customer FROM sales JOIN runs ON created_at < started_at "
    "GROUP BY coalesce(property_type, 'Unknown'), started_at", runs=_RUNS_SQL))
def sum_by_key_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = A.cells_by(_runs(month_cells(spark, sf_dir)), "property_type", "town", "started_at")
    return view_sum_by_key_run(view, "property_type")


@query("latest_run", on_sales(
    f"SELECT round(sum(sales_ratio), 4) AS total_sales_ratio, "
    f"round(sum(sale_amount), 2) AS total_sale_amount, count(*) AS total_customer, started_at, "
    f"started_at + INTERVAL 5 MINUTE AS ended_at FROM sales JOIN runs ON created_at < started_at "
    f"WHERE {COMPLETE} GROUP BY started_at ORDER BY ended_at DESC LIMIT 1", runs=_RUNS_SQL))
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = A.cells_totals(_runs(month_totals(spark, sf_dir)), "started_at").withColumn(
        "ended_at", F.col("started_at") + F.expr("INTERVAL 5 MINUTES"))
    return latest(history).withColumns({
        "total_sales_ratio": F.round("total_sales_ratio", 4),
        "total_sale_amount": F.round("total_sale_amount", 2)})


def _mode_sql(column: str) -> str:
    return (f"SELECT '{column}' AS column_name, (SELECT {column} FROM sales WHERE {column} "
            f"IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1) AS mode")


@query("column_mode", on_sales(
    _mode_sql("property_type") + " UNION ALL " + _mode_sql("residential_type")))
def column_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["property_type", "residential_type"]
    return A.column_modes(sales(spark, sf_dir, *columns), columns)


@query("mean_by_key", on_sales(
    "SELECT town, round(avg(sale_amount), 4) AS mean_amount FROM sales "
    "WHERE town IS NOT NULL GROUP BY town"))
def mean_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = A.mean_by_key(sales(spark, sf_dir, "town", "sale_amount"), "town", "sale_amount",
                          "mean_amount")
    return means.withColumn("mean_amount", F.round("mean_amount", 4))


@query("batch_row_count", on_sales(
    "SELECT count(*) AS written, count(*) FILTER (sales_ratio IS NOT NULL AND "
    "NOT isnan(sales_ratio) AND sale_amount IS NOT NULL) AS complete FROM sales"))
def batch_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, "sales_ratio", "sale_amount")
    seen_rows, seen = A.observed_rows(rows)
    kept_rows, kept = A.observed_rows(drop_incomplete(seen_rows))
    kept_rows.write.parquet(work_dir(spark, "written"))  # both counts come from this one job
    return spark.createDataFrame(
        [(seen.get["rows"], kept.get["rows"])], "written long, complete long")


@query("ratio_of_sums", on_sales(
    f"SELECT list_year, round(sum(sales_ratio) / count(*), 6) AS average_sale_ratio "
    f"FROM sales WHERE {COMPLETE} GROUP BY list_year"))
def ratio_of_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drop_incomplete(sales(spark, sf_dir, "list_year", "sales_ratio", "sale_amount"))
    return rows.groupBy("list_year").agg(
        F.round(A.ratio_of_sums(F.sum("sales_ratio"), F.count(F.lit(1))), 6)
        .alias("average_sale_ratio"))


@query("sort_by_date", on_sales(
    f"SELECT {DATE_TEXT}, serial_number, sale_amount FROM sales"))
def sorted_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_sales(spark, sales_files(spark, sf_dir)).select(
        "date_recorded", "serial_number", "sale_amount")
    return date_text(sort_by_date(rows, "serial_number"))


@query("bounded_sample", "SELECT least(count(*), 1000) AS n FROM lineitem")
def sample_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounded_sample(sales(spark, sf_dir, "serial_number")).agg(
        F.count(F.lit(1)).alias("n"))


@query("preview", on_sales(
    f"SELECT serial_number, {DATE_TEXT}, location FROM "
    f"(SELECT * FROM sales ORDER BY date_recorded, serial_number, location LIMIT 5)"))
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(spark, sf_dir, "serial_number", "date_recorded", "location")
    return date_text(preview(rows, 5, "date_recorded", "serial_number", "location"))
