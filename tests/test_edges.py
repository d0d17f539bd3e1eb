"""Hand-made rows: nulls, NaN, blanks, malformed messages, bad dates, empty input."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow import schemas
from salesflow.functions import cleaning as C
from salesflow.functions import wire as W
from salesflow.operators import aggregates as A
from salesflow.operators.ordering import bounded_sample, preview, sort_by_date

SCHEMA = "property_type string, serial_number long, sale_amount double, sales_ratio double"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([
        ("A", 1, 10.0, 0.5), (None, None, 20.0, None), ("", 3, float("nan"), 0.7),
        ("A", None, 5.0, 0.1), ("Unknown", 4, 1.0, 1.0)], SCHEMA)


def test_count_by(rows):
    assert {r.property_type: r.total_customer for r in A.count_by(rows, "property_type").collect()
            } == {"": 1, "A": 2, "Unknown": 2}


def test_totals(rows):
    row = A.totals(rows).first()
    assert (round(row.total_sales_ratio, 9), row.total_sale_amount, row.total_customer) == (
        1.6, 16.0, 3)


def test_empty_input(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert A.count_by(nothing, "property_type").collect() == []
    assert tuple(A.totals(nothing).first()) == (None, None, 0)


def test_cells_give_the_same_as_direct_aggregates(rows):
    with_town = rows.withColumn("town", F.lit("T"))
    cells = A.sale_cells(with_town, "property_type", "town")
    assert sorted(map(tuple, A.cells_by(cells, "property_type").collect())) == sorted(
        map(tuple, A.count_by(rows, "property_type").collect()))
    assert tuple(A.cells_totals(cells).first()) == pytest.approx(tuple(A.totals(rows).first()))


def test_modes_prefer_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None), (None, None)],
                               "x string, y string")
    assert {r.column_name: r.mode for r in A.column_modes(df, ["x", "y"]).collect()} == {"x": "a"}


def test_mean_ignores_missing_values_and_keys(spark):
    df = spark.createDataFrame(
        [("t", 1.0), ("t", float("nan")), ("t", None), (None, 9.0), ("u", None)],
        "town string, v double")
    assert {tuple(r) for r in A.mean_by_key(df, "town", "v", "m").collect()} == {
        ("t", 1.0), ("u", None)}


def test_observed_rows(rows):
    counted, seen = A.observed_rows(rows)
    counted.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 5}


def test_ratio_of_sums_by_zero(spark):
    row = spark.range(1).select(A.ratio_of_sums(F.lit(1.0), F.lit(0)).alias("r")).first()
    assert row.r is None




def test_snake_case_and_rename(spark):
    df = spark.createDataFrame([(1, 2)], ["Serial Number", "OPM remarks"])
    assert C.snake_case(df).columns == ["serial_number", "opm_remarks"]
    assert C.rename_to(df, ["A", "B"]).columns == ["A", "B"]
    with pytest.raises(ValueError):
        C.rename_to(df, ["A"])


def test_blank_to_null_does_not_trim(spark):
    df = spark.createDataFrame([("", 1), (" ", 2), ("x", 3)], "s string, n long")
    assert [r.s for r in C.blank_to_null(df).orderBy("n").collect()] == [None, " ", "x"]


def test_fill_unknown_leaves_numbers_and_blanks(spark):
    df = spark.createDataFrame([(None, None), ("", 1)], "s string, n long")
    assert {tuple(r) for r in C.fill_unknown(df).collect()} == {("Unknown", None), ("", 1)}


def test_open_range_excludes_bounds_null_and_nan(spark):
    df = spark.createDataFrame([(v,) for v in (0.3, 0.31, 1.29, 1.3, None, float("nan"))],
                               "r double")
    assert [r.r for r in C.open_range(df, "r", 0.3, 1.3).orderBy("r").collect()] == [0.31, 1.29]


def test_below_excludes_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (None,), (float("nan"),)], "x double")
    assert [r.x for r in C.below(df, "x", 5.0).collect()] == [1.0]


def test_dates(spark):
    df = spark.createDataFrame(
        [("2020-01-02",), ("01/02/2020",), ("",), (None,), ("soon",)], "d string")
    got = df.select(C.parse_date_any(F.col("d")).cast("string").alias("any"),
                    C.parse_date(F.col("d")).cast("string").alias("iso")).collect()
    assert [r["any"] for r in got] == ["2020-01-02", "2020-01-02", None, None, None]
    assert [r["iso"] for r in got] == ["2020-01-02", None, None, None, None]


def test_cast_sales_nulls_what_does_not_parse(spark):
    df = spark.createDataFrame([("7", "x", "1.5")], "serial_number string, list_year string, "
                                                    "sale_amount string")
    target = T.StructType([schemas.SALE[c] for c in df.columns])
    assert tuple(C.cast_sales(df, target).first()) == (7, None, 1.5)


def test_text_between(spark):
    df = spark.createDataFrame([("<a><b>",), ("none",), (None,)], "s string")
    got = [r.t for r in df.select(C.text_between(F.col("s"), "<", ">").alias("t")).collect()]
    assert got == [["a", "b"], [], None]


def test_scaled_rounds_half_to_even(spark):
    row = spark.range(1).select(
        C.scaled(F.lit(2.5)).alias("a"), C.scaled(F.lit(3.5)).alias("b"),
        C.scaled(F.lit(1_250_000_000.0), 1e9, 1).alias("c")).first()
    assert tuple(row) == (2.0, 4.0, 1.2)


# --- wire ---------------------------------------------------------------------

WIRE = T.StructType([
    T.StructField("a", T.DoubleType()), T.StructField("b", T.StringType()),
    T.StructField("n", T.LongType())])
CASES = [
    ('{"a":1,"b":"x"}', (1.0, "x", None)),
    ('{"a":"NaN"}', ("nan", None, None)),
    ('{"a":"oops","b":"k"}', (None, "k", None)),
    ('{"n":1.5,"b":7}', (None, "7", None)),
    ('{"b":"y","extra":1}', (None, "y", None)),
    ("{}", (None, None, None)),
    ("not json", "dropped"),
    ('{"a":"oops"}', "dropped"),
    (None, "dropped"),
]


def _plain(row):
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row)


@pytest.mark.parametrize("message,expected", CASES)
def test_decode(spark, message, expected):
    df = spark.createDataFrame([(message,)], "value string")
    got = [_plain(r) for r in W.decode(df, WIRE).collect()]
    assert got == ([] if expected == "dropped" else [expected])


def test_quarantine(spark):
    df = spark.createDataFrame([(m,) for m, _ in CASES], "value string")
    got = {r.value: r.dropped for r in W.quarantine(df, WIRE).collect()}
    assert got == {'{"a":"oops","b":"k"}': False, '{"n":1.5,"b":7}': False, "not json": True,
                   '{"a":"oops"}': True, None: True}


def test_encode_leaves_out_nulls_and_decode_restores(spark):
    df = spark.createDataFrame([(1.5, None, 3), (float("nan"), 'q"\n', None)], WIRE)
    messages = W.encode(df)
    assert '"b"' not in messages.first().value
    assert {_plain(r) for r in W.decode(messages, WIRE).collect()} == {
        _plain(r) for r in df.collect()}


def test_bytes(spark):
    df = spark.createDataFrame([(bytearray(b'{"b":"\xc3\xa9"}'),)], "value binary")
    assert W.decode(W.as_text(df), WIRE).first().b == "é"


# --- contracts and limits --------------------------------------------------------


def test_conform(spark):
    df = spark.createDataFrame([(1, "t")], "total_customer int, town string").withColumn(
        "created_at", C.ntz("2020-01-01 00:00:00"))
    assert schemas.conform(df, schemas.SPEED_BY_TOWN).schema == schemas.SPEED_BY_TOWN
    with pytest.raises(schemas.SchemaError):
        schemas.conform(df.drop("town"), schemas.SPEED_BY_TOWN)
    with pytest.raises(schemas.SchemaError):
        schemas.conform(df.withColumn("x", F.lit(1)), schemas.SPEED_BY_TOWN)
    with pytest.raises(PySparkException):
        bad = df.withColumn("total_customer", F.lit("many"))
        schemas.conform(bad, schemas.SPEED_BY_TOWN).collect()


def test_orders_and_limits(spark):
    df = spark.createDataFrame([("2020-01-02", 1), ("2020-01-01", 3), ("2020-01-01", 2)],
                               "date_recorded string, serial_number long")
    assert [r.serial_number for r in sort_by_date(df, "serial_number").collect()] == [2, 3, 1]
    assert [r.serial_number for r in preview(df, 2, "serial_number").collect()] == [1, 2]
    assert bounded_sample(df, 2).count() == 2
