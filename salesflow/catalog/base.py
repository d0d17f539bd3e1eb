"""Registry, the oracle's sales view, and helpers that several queries share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow import schemas
from salesflow.functions.cleaning import ntz
from salesflow.functions.wire import decode, encode
from salesflow.operators.aggregates import VIEW_KEYS, cells_by, cells_totals, sale_cells
from salesflow.session import stage, work_dir
from salesflow.sources.files import part_count, read_sales, split_by_date
from salesflow.sources.log import remove
from salesflow.sources.testdata import is_large, sales, sales_files, sales_once
from salesflow.streaming.bus import Topic

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The derived sales, for the oracle.
SALES_VIEW = """
SELECT
  l_orderkey * 10 + l_linenumber                       AS serial_number,
  CAST(year(l_shipdate) AS BIGINT)                     AS list_year,
  CAST(l_shipdate AS DATE)                             AS date_recorded,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE n_name END AS town,
  c_name                                               AS address,
  p_retailprice * l_quantity                           AS assessed_value,
  CASE WHEN l_linenumber = 6 THEN NULL ELSE l_extendedprice END AS sale_amount,
  CASE WHEN l_linenumber = 5 THEN NULL
       WHEN l_linenumber = 3 AND l_quantity = 50 THEN CAST('NaN' AS DOUBLE)
       ELSE l_quantity / CAST(40 AS DOUBLE) END        AS sales_ratio,
  CASE WHEN l_linenumber = 4 THEN NULL
       WHEN l_linenumber = 2 AND l_returnflag = 'A' THEN ''
       ELSE CASE p_type WHEN 'ECONOMY' THEN 'Condo' WHEN 'LARGE' THEN 'Commercial'
            WHEN 'MEDIUM' THEN 'Single Family' WHEN 'PROMO' THEN 'Vacant Land'
            WHEN 'SMALL' THEN 'Two Family' ELSE 'Residential' END END AS property_type,
  CASE WHEN l_linenumber >= 3 THEN NULL
       WHEN l_linestatus = 'F' THEN 'Single Family' ELSE 'Condo' END AS residential_type,
  CAST(NULL AS VARCHAR)                                AS non_use_code,
  CASE WHEN l_tax = 0 THEN '' ELSE o_orderpriority END AS assessor_remarks,
  o_orderstatus                                        AS opm_remarks,
  concat('POINT (', l_suppkey, ' ', l_partkey, ')')    AS location,
  l_shipdate                                           AS created_at
FROM lineitem
JOIN part     ON p_partkey   = l_partkey
JOIN orders   ON o_orderkey  = l_orderkey
JOIN customer ON c_custkey   = o_custkey
JOIN nation   ON n_nationkey = c_nationkey
"""

# The date as text, see date_text.
DATE_TEXT = "CAST(date_recorded AS VARCHAR) AS date_recorded"

# Fixed moments of the queries.
CUTOFF = "1997-01-01 00:00:00"
ENDED = "1997-01-01 00:05:00"
NOW = "1998-07-01 00:00:00"
STAMP = "2002-01-01 00:00:00"


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its oracle, over a view ``sales`` (see :func:`on_sales`)."""
    def add(function: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function
    return add


def on_sales(select: str, **views: str) -> str:
    """An oracle over ``sales`` and further named subqueries."""
    named = {"sales": SALES_VIEW, **views}
    return "WITH " + ",\n".join(f"{n} AS ({v})" for n, v in named.items()) + "\n" + select


# --- digest: one row per year and type that changes if any row is lost, doubled or altered

def date_text(df: DataFrame) -> DataFrame:
    """The date as text: results compare alike in every engine."""
    return df.withColumn("date_recorded", F.col("date_recorded").cast("string"))


# Every column of a row that both engines write as the same text.
_HASHED = ("serial_number", "date_recorded", "town", "address", "residential_type", "non_use_code",
           "assessor_remarks", "opm_remarks", "location")
_HASH_SQL = "md5(concat_ws('|', " + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), '~')" for c in _HASHED) + "))"


def row_hash() -> Column:
    """32 bits of the MD5 of a row; their sum tells any changed or swapped value."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in _HASHED]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("bigint")


def digest(df: DataFrame) -> DataFrame:
    def size(column: str):
        return F.coalesce(F.sum(F.length(column)), F.lit(0)).alias(f"{column}_size")

    ratio = F.when(~F.isnan("sales_ratio"), F.col("sales_ratio"))
    return df.groupBy("list_year", "property_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("serial_number").alias("serials"),
        F.min("date_recorded").cast("string").alias("first_date"),
        F.max("date_recorded").cast("string").alias("last_date"),
        F.round(F.sum("assessed_value"), 2).alias("assessed"),
        F.round(F.sum("sale_amount"), 2).alias("amount"),
        F.round(F.sum(ratio), 4).alias("ratio"),
        F.count_if(F.isnan("sales_ratio")).alias("nan_ratios"),
        F.count("town").alias("towns"), F.sum(row_hash()).alias("hashes"),
        size("address"), size("residential_type"), size("assessor_remarks"), size("location"))


def digest_sql(source: str = "sales", more: str = "") -> str:
    sizes = ", ".join(
        f"CAST(coalesce(sum(length({c})), 0) AS BIGINT) AS {c}_size"
        for c in ("address", "residential_type", "assessor_remarks", "location"))
    return f"""
SELECT list_year, property_type, count(*) AS n, CAST(sum(serial_number) AS BIGINT) AS serials,
  CAST(min(date_recorded) AS VARCHAR) AS first_date,
  CAST(max(date_recorded) AS VARCHAR) AS last_date,
  round(sum(assessed_value), 2) AS assessed, round(sum(sale_amount), 2) AS amount,
  round(sum(CASE WHEN NOT isnan(sales_ratio) THEN sales_ratio END), 4) AS ratio,
  count(*) FILTER (isnan(sales_ratio)) AS nan_ratios, count(town) AS towns,
  CAST(sum(CAST('0x' || substr({_HASH_SQL}, 1, 8) AS BIGINT)) AS BIGINT) AS hashes, {sizes}{more}
FROM {source} GROUP BY list_year, property_type"""


# --- inputs of the file and stream queries

# A micro-batch takes so many files of at least PART_ROWS rows. Files grow until the input makes TICKS micro-batches of
# them, as each has a price of its own; at MOST_PART_ROWS (some 30 MB of JSON, compressed) they stop growing, and
# more input makes more micro-batches.
PART_ROWS = 20_000
MOST_PART_ROWS = 500_000
FILES_PER_TICK = 8
TICKS = 16


def part_rows(rows: int) -> int:
    """How many rows a part file of a feed of ``rows`` rows has."""
    return max(PART_ROWS, min(MOST_PART_ROWS, -(-rows // (TICKS * FILES_PER_TICK))))


_FEEDS: dict[tuple[str, str, str], tuple] = {}


def feed_parts(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """The sales as part files of :func:`part_rows` rows in date order, and how many make one tick.

    Written once per application.
    """
    return _kept(spark, sf_dir, _store_parts)


def _store_parts(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    path = work_dir(spark, "parts")
    with sales_once(spark, sf_dir) as files:
        prepared = read_sales(spark, files)
        rows = prepared.count()
        split_by_date(prepared, part_count(rows, part_rows(rows), least=1), path)
    return path, FILES_PER_TICK


def message_topic(spark: SparkSession, sf_dir: str) -> tuple[Topic, int]:
    """The sales as messages in a folder topic; written once per application."""
    return _kept(spark, sf_dir, _store_topic)


def _store_topic(spark: SparkSession, sf_dir: str) -> tuple[Topic, int]:
    with _once(spark, sf_dir, _store_parts) as (parts, per_tick):
        prepared = read_sales(spark, parts)
        return store_messages(encode(prepared), prepared.count()), per_tick


def _key(spark: SparkSession, sf_dir: str, store: Callable[[SparkSession, str], tuple]) -> tuple[str, str, str]:
    return spark.sparkContext.applicationId, sf_dir, store.__name__


def _kept(spark: SparkSession, sf_dir: str, store: Callable[[SparkSession, str], tuple]) -> tuple:
    key = _key(spark, sf_dir, store)
    if key not in _FEEDS:
        _FEEDS[key] = store(spark, sf_dir)
    return _FEEDS[key]


@contextmanager
def _once(spark: SparkSession, sf_dir: str, store: Callable[[SparkSession, str], tuple]) -> Iterator[tuple]:
    """A feed for a reader that stores what it makes of it: a large one is removed then, unless a query has it already."""
    if _key(spark, sf_dir, store) in _FEEDS or not is_large(spark, sf_dir):
        yield _kept(spark, sf_dir, store)
        return
    feed, per_tick = store(spark, sf_dir)
    try:
        yield feed, per_tick
    finally:
        remove(spark, feed.options["path"] if isinstance(feed, Topic) else feed)


def store_messages(messages: DataFrame, rows: int) -> Topic:
    """A new folder topic with ``rows`` messages, in files no larger than a feed's parts; nothing is shuffled."""
    path = work_dir(messages.sparkSession, "topic")
    messages.write.option("maxRecordsPerFile", part_rows(rows)).option("compression", "zstd").parquet(path)
    return Topic.folder(path)


def damaged_topic(spark: SparkSession, sf_dir: str) -> tuple[Topic, int]:
    """The messages of :func:`message_topic`, those with a serial number that ends in 1 cut off after five letters."""
    with _once(spark, sf_dir, _store_topic) as (topic, per_tick):
        stored = spark.read.parquet(topic.options["path"])
        value = F.to_json(F.struct("*"))
        cut = F.when(F.col("serial_number") % 10 == 1, F.left(value, F.lit(5))).otherwise(value)
        return store_messages(decode(stored).select(cut.alias("value")), stored.count()), per_tick


def lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived sales as a stored lake table."""
    return spark.read.schema(schemas.LAKE).parquet(sales_files(spark, sf_dir, lake=True))


# --- batch and speed views split at the cutoff


def month_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells per month of creation, stored: the sales are read once per query."""
    rows = sales(spark, sf_dir, "property_type", "town", "sales_ratio", "sale_amount",
                 "date_recorded")
    return stage(sale_cells(_monthly(rows), *VIEW_KEYS, "created_at"), "cells")


def month_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like :func:`month_cells` without the keys; reads one table and no keys."""
    rows = _monthly(sales(spark, sf_dir, "sales_ratio", "sale_amount", "date_recorded"))
    return stage(sale_cells(rows, "created_at"), "cells")


def _monthly(rows: DataFrame) -> DataFrame:
    month = F.trunc("date_recorded", "month").cast("timestamp_ntz")
    return rows.withColumn("created_at", month)


def batch_of(cells: DataFrame, key: str | None = None) -> DataFrame:
    before = cells.filter(F.col("created_at") < ntz(CUTOFF))
    view = cells_by(before, key) if key else cells_totals(before)
    return view.withColumns({"started_at": ntz(CUTOFF), "ended_at": ntz(ENDED)})


def speed_of(cells: DataFrame, key: str | None = None) -> DataFrame:
    after = cells.filter(F.col("created_at") >= ntz(CUTOFF))
    return cells_by(after, key, "created_at") if key else cells_totals(after, "created_at")


COMPLETE = ("sales_ratio IS NOT NULL AND NOT isnan(sales_ratio) "
            "AND sale_amount IS NOT NULL AND NOT isnan(sale_amount)")
TOTALS = ("sum(sales_ratio) AS total_sales_ratio, sum(sale_amount) AS total_sale_amount, "
          "count(*) AS total_customer")
BATCH_TOTALS_SQL = f"""
SELECT {TOTALS}, TIMESTAMP '{CUTOFF}' AS started_at, TIMESTAMP '{ENDED}' AS ended_at
FROM sales WHERE created_at < TIMESTAMP '{CUTOFF}' AND {COMPLETE}"""
SPEED_TOTALS_SQL = f"""
SELECT sum(CASE WHEN {COMPLETE} THEN sales_ratio END) AS total_sales_ratio,
  sum(CASE WHEN {COMPLETE} THEN sale_amount END) AS total_sale_amount,
  count(*) FILTER ({COMPLETE}) AS total_customer, date_trunc('month', created_at) AS created_at
FROM sales WHERE created_at >= TIMESTAMP '{CUTOFF}'
GROUP BY date_trunc('month', created_at)"""


def batch_sql(key: str) -> str:
    return f"""
SELECT coalesce({key}, 'Unknown') AS {key}, count(*) AS total_customer,
  TIMESTAMP '{CUTOFF}' AS started_at, TIMESTAMP '{ENDED}' AS ended_at
FROM sales WHERE created_at < TIMESTAMP '{CUTOFF}' GROUP BY coalesce({key}, 'Unknown')"""


def speed_sql(key: str, unit: str = "month") -> str:
    return f"""
SELECT coalesce({key}, 'Unknown') AS {key}, count(*) AS total_customer,
  date_trunc('{unit}', created_at) AS created_at
FROM sales WHERE created_at >= TIMESTAMP '{CUTOFF}'
GROUP BY coalesce({key}, 'Unknown'), date_trunc('{unit}', created_at)"""


def served_sql(key: str) -> str:
    """Merged counts: the newest run plus the partials of the window."""
    return f"""
SELECT {key}, CAST(sum(total_customer) AS BIGINT) AS total_customer FROM (
  SELECT {key}, total_customer FROM batch_view
  UNION ALL
  SELECT {key}, total_customer FROM speed_view
  WHERE created_at >= (SELECT max(started_at) FROM batch_view)
    AND created_at <= TIMESTAMP '{NOW}')
GROUP BY {key}"""


def on_views(select: str, key: str | None = None) -> str:
    """An oracle over ``batch_view`` and ``speed_view``."""
    if key:
        return on_sales(select, batch_view=batch_sql(key), speed_view=speed_sql(key))
    return on_sales(select, batch_view=BATCH_TOTALS_SQL, speed_view=SPEED_TOTALS_SQL)
