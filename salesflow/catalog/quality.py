"""Data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow import schemas
from salesflow.catalog.base import CUTOFF, ENDED, on_sales, query
from salesflow.functions.cleaning import ntz, stamp
from salesflow.operators import quality as Q
from salesflow.operators.aggregates import count_by, totals
from salesflow.session import work_dir
from salesflow.sources.tables import publish_view, read_view
from salesflow.sources.testdata import sales

_STAMPED = f"TIMESTAMP '{CUTOFF}' AS started_at, TIMESTAMP '{ENDED}' AS ended_at"


def _view(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return stamp(count_by(sales(spark, sf_dir, key), key),
                 started_at=ntz(CUTOFF), ended_at=ntz(ENDED))


def _view_sql(key: str) -> str:
    return (f"SELECT coalesce({key}, 'Unknown') AS {key}, count(*) AS total_customer, {_STAMPED} "
            f"FROM sales GROUP BY coalesce({key}, 'Unknown')")


_VIEWS = {"by_type": _view_sql("property_type"), "by_town": _view_sql("town")}


def _row(suite: str, kind: str, column: str | None, source: str, unexpected: str) -> str:
    name = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return (f"SELECT '{suite}' AS suite, '{kind}' AS expectation, {name} AS column_name, "
            f"({unexpected}) = 0 AS success, count(*) AS element_count, "
            f"CAST({unexpected} AS BIGINT) AS unexpected_count FROM {source}")


def _checked_sql(suite: str, source: str, column: str, at_least: int | None = None) -> list[str]:
    rows = [_row(suite, Q.NOT_NULL, column, source, f"count(*) FILTER ({column} IS NULL)"),
            _row(suite, Q.TYPE_IN, column, source, "0")]
    if at_least is not None:
        rows.append(_row(suite, Q.BETWEEN, column, source,
                         f"count(*) FILTER ({column} < {at_least})"))
    return rows


_SET = ", ".join(f"'{v}'" for v in Q.PROPERTY_TYPES)
_NOT_IN_SET = f"count(*) FILTER (property_type NOT IN ({_SET}))"


@query("expect_columns_ordered", on_sales(
    " UNION ALL ".join([
        _row("order", Q.COLUMNS_ORDERED, None, "by_type", "0"),
        _row("wrong order", Q.COLUMNS_ORDERED, None, "by_type", "count(*)")]), **_VIEWS))
def expect_columns_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _view(spark, sf_dir, "property_type")
    right = Q.columns_ordered("property_type", "total_customer", "started_at", "ended_at")
    wrong = Q.columns_ordered("total_customer", "property_type", "started_at", "ended_at")
    return Q.validate(view, Q.Suite("order", (right,))).unionByName(
        Q.validate(view, Q.Suite("wrong order", (wrong,))))


@query("expect_in_set", on_sales(
    _row("set", Q.IN_SET, "property_type", "sales", _NOT_IN_SET)))
def expect_in_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.validate(sales(spark, sf_dir, "property_type"),
                      Q.Suite("set", (Q.in_set("property_type", Q.PROPERTY_TYPES),)))


_NULLABLE = ["town", "property_type", "sale_amount", "serial_number"]


@query("expect_not_null", on_sales(" UNION ALL ".join(
    _row("nulls", Q.NOT_NULL, c, "sales", f"count(*) FILTER ({c} IS NULL)") for c in _NULLABLE)))
def expect_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.validate(sales(spark, sf_dir, *_NULLABLE),
                      Q.Suite("nulls", tuple(Q.not_null(c) for c in _NULLABLE)))


@query("expect_type_in", on_sales(" UNION ALL ".join([
    _row("types", Q.TYPE_IN, "property_type", "sales", "0"),
    _row("types", Q.TYPE_IN, "serial_number", "sales", "0"),
    _row("types", Q.TYPE_IN, "created_at", "sales", "0"),
    _row("types", Q.TYPE_IN, "sale_amount", "sales", "count(*)")])))
def expect_type_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("property_type", "serial_number", "created_at", "sale_amount")
    return Q.validate(sales(spark, sf_dir, *names), Q.Suite("types", (
        Q.type_in("property_type", "VARCHAR"), Q.type_in("serial_number", "DECIMAL"),
        Q.type_in("created_at", "TIMESTAMP_NTZ"), Q.type_in("sale_amount", "DECIMAL"))))


@query("expect_between", on_sales(" UNION ALL ".join([
    _row("range", Q.BETWEEN, "list_year", "sales",
         "count(*) FILTER (list_year < 1996 OR list_year > 2000)"),
    _row("range", Q.BETWEEN, "sale_amount", "sales", "count(*) FILTER (sale_amount < 5000)")])))
def expect_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.validate(sales(spark, sf_dir, "list_year", "sale_amount"), Q.Suite("range", (
        Q.between("list_year", 1996, 2000), Q.between("sale_amount", 5000))))


def _by_key_sql(suite: str, source: str, key: str) -> list[str]:
    return [
        _row(suite, Q.COLUMNS_ORDERED, None, source, "0"),
        *_checked_sql(suite, source, key),
        *_checked_sql(suite, source, "total_customer", 1),
        *_checked_sql(suite, source, "started_at"),
        *_checked_sql(suite, source, "ended_at"),
    ]


_TYPE_SUITE, _TOWN_SUITE = "total_customer_by_property_type_suite", "total_customer_by_town_suite"
_TOTALS_SUITE = "total_sale_amount_ratio_suite"
_TOTALS_VIEW = (
    f"SELECT sum(sales_ratio) AS total_sales_ratio, sum(sale_amount) AS total_sale_amount, "
    f"count(*) AS total_customer, {_STAMPED} FROM sales WHERE sale_amount IS NOT NULL "
    f"AND sales_ratio IS NOT NULL AND NOT isnan(sales_ratio)")
_TYPE_ROWS = [_row(_TYPE_SUITE, Q.IN_SET, "property_type", "by_type", _NOT_IN_SET),
              *_by_key_sql(_TYPE_SUITE, "by_type", "property_type")]


@query("validate_suite", on_sales(" UNION ALL ".join([
    *_TYPE_ROWS,
    *_by_key_sql(_TOWN_SUITE, "by_town", "town"),
    _row(_TOTALS_SUITE, Q.COLUMNS_ORDERED, None, "total", "0"),
    *_checked_sql(_TOTALS_SUITE, "total", "total_sales_ratio"),
    *_checked_sql(_TOTALS_SUITE, "total", "total_sale_amount"),
    *_checked_sql(_TOTALS_SUITE, "total", "total_customer", 1),
    *_checked_sql(_TOTALS_SUITE, "total", "started_at"),
    *_checked_sql(_TOTALS_SUITE, "total", "ended_at"),
]), **_VIEWS, total=_TOTALS_VIEW))
def validate_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = stamp(totals(sales(spark, sf_dir, "sales_ratio", "sale_amount")),
                  started_at=ntz(CUTOFF), ended_at=ntz(ENDED))
    return (
        Q.validate(_view(spark, sf_dir, "property_type"), Q.property_type_suite())
        .unionByName(Q.validate(_view(spark, sf_dir, "town"), Q.town_suite()))
        .unionByName(Q.validate(total, Q.totals_suite()))
    )


@query("suite_store", on_sales(" UNION ALL ".join(_TYPE_ROWS), **_VIEWS))
def suite_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Q.SuiteStore(spark, work_dir(spark, "suites"))
    empty = store.get_or_create(_TYPE_SUITE)  # nothing stored yet: a new, empty suite
    store.save(Q.property_type_suite())
    stored = store.get_or_create(empty.name)
    return Q.validate(_view(spark, sf_dir, "property_type"), stored)


@query("validated_publish", on_sales(
    f"SELECT coalesce(town, 'Unknown') AS town, count(*) AS total_customer, {_STAMPED} "
    f"FROM sales GROUP BY coalesce(town, 'Unknown')"))
def validated_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    view, path = _view(spark, sf_dir, "town"), work_dir(spark, "view")

    def check(written: DataFrame) -> None:
        Q.require(Q.validate(written, Q.town_suite()))

    publish_view(view, path, "good", schemas.BATCH_BY_TOWN, check)
    spoiled = view.withColumn("total_customer", F.lit(0).cast("long"))
    try:
        publish_view(spoiled, path, "bad", schemas.BATCH_BY_TOWN, check)
    except Q.ValidationError:
        pass  # refused: readers still see the first run
    return read_view(spark, path, schemas.BATCH_BY_TOWN)


@query("republish_same_run", on_sales(_view_sql("town")))
def republish_same_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run tried again under its id and refused: readers keep what was released."""
    view, path = _view(spark, sf_dir, "town"), work_dir(spark, "view")

    def check(written: DataFrame) -> None:
        Q.require(Q.validate(written, Q.town_suite()))

    publish_view(view, path, "run", schemas.BATCH_BY_TOWN, check)
    before = read_view(spark, path, schemas.BATCH_BY_TOWN)
    spoiled = view.withColumn("total_customer", F.lit(0).cast("long"))
    try:
        publish_view(spoiled, path, "run", schemas.BATCH_BY_TOWN, check)
    except Q.ValidationError:
        pass
    # a reader that began earlier still has its files, and a new one sees the same rows
    return read_view(spark, path, schemas.BATCH_BY_TOWN).intersectAll(before)
