"""What the plans do at scale: pruning, pushdown, single passes, no nested loops, no Python."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from salesflow import schemas
from salesflow.functions.cleaning import ntz
from salesflow.functions.wire import decode
from salesflow.operators import aggregates as A
from salesflow.operators import serving as S
from salesflow.sources.tables import created_before, read_since
from salesflow.sources.testdata import sales
from salesflow.streaming.layers import Tables, partial_views, read_lake, read_speed, write_speed
from salesflow.sources.tables import write_batch

QUERIES = entry_point.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    made = Tables(str(tmp_path_factory.mktemp("tables")))
    rows = sales(spark, sf_dir).withColumn(
        "created_at", F.trunc("date_recorded", "year").cast("timestamp_ntz"))
    write_batch(rows, made.lake, 0, schemas.LAKE)
    write_speed(rows, 0, made)
    return made


def test_totals_read_one_table_and_few_columns(spark, sf_dir):
    df = QUERIES["batch_totals"](spark, sf_dir)
    text = plan(df)
    assert scans(df) == 1
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double,l_extendedprice:double>" in text
    assert "partial_sum" in text


def test_count_is_partial_then_final(spark, sf_dir):
    text = plan(A.count_by(sales(spark, sf_dir, "property_type"), "property_type"))
    assert "partial_count" in text and text.count("hashpartitioning(property_type") == 1


def test_filters_reach_the_files_and_prune_dates(spark, tables):
    lake = read_lake(spark, tables)
    for df in (created_before(lake, ntz("1997-01-01 00:00:00")),
               read_since(lake, ntz("1997-01-01 00:00:00"), ntz("1998-01-01 00:00:00"))):
        text = plan(df.select("town", "created_at"))
        assert "PartitionFilters: [isnotnull(created_date" in text
        assert "LessThan" in text.split("PushedFilters:")[1].splitlines()[0]


def test_serving_is_scalar_subqueries_and_prunes(spark, sf_dir, tables):
    speed = {v: read_speed(spark, tables, v) for v in ("town", "totals")}
    at = {"started_at": ntz("1997-01-01 00:00:00"), "ended_at": ntz("1997-01-01 00:05:00")}
    batch = A.count_by(sales(spark, sf_dir, "town"), "town").withColumns(at)
    totals = A.totals(sales(spark, sf_dir, "sales_ratio", "sale_amount")).withColumns(at)
    now = ntz("2030-01-01 00:00:00")
    for df in (S.serve_by_key(batch, speed["town"], "town", now),
               S.serve_totals(totals, speed["totals"], now)):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text
        assert "Subquery" in text
        assert "created_date" in text.split("PartitionFilters:")[1].splitlines()[0]


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    counts = A.count_by(sales(spark, sf_dir, "town"), "town")
    assert "TakeOrderedAndProject" in plan(S.top_k(counts, "total_customer", "town"))


def test_messages_are_parsed_once(spark):
    df = spark.range(5).select(F.format_string('{"town":"T%s"}', "id").alias("value"))
    text = decode(df).filter("town = 'T1'")._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def test_partial_views_scan_once(spark, sf_dir):
    tables = ("lineitem", "part", "orders", "customer", "nation")
    assert scans(partial_views(sales(spark, sf_dir))) == len(tables)


PYTHON_FREE = [
    "batch_count_by_town", "batch_totals", "json_encode", "json_decode", "column_mode",
    "serve_by_town", "top_towns", "validate_suite", "lookup_encode", "feature_frame", "predict",
]


@pytest.mark.parametrize("name", PYTHON_FREE)
def test_no_python_workers(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("EvalPython", "InPandas", "InArrow", "ExistingRDD"):
        assert node not in text
    assert "NestedLoop" not in text and "Cartesian" not in text
