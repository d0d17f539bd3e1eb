"""Structured Streaming: publishing, the lake, the speed views, triggers, restarts."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow import schemas
from salesflow.catalog.base import (
    COMPLETE, STAMP, damaged_topic, digest, digest_sql, feed_parts, message_topic, on_sales, query)
from salesflow.functions.cleaning import cast_sales, ntz
from salesflow.functions.wire import decode
from salesflow.session import work_dir
from salesflow.sources.tables import write_batch
from salesflow.streaming.bus import Topic, for_each_batch, publish, stream_sales, subscribe
from salesflow.streaming.layers import (
    SPEED_VIEWS, Tables, read_lake, read_speed, run_ingest, run_lake, run_quarantine,
    run_speed_views, to_lake_rows)


def _speed(spark: SparkSession, sf_dir: str, *views: str) -> Tables:
    topic, per_tick = message_topic(spark, sf_dir)
    tables = Tables(work_dir(spark, "speed"))
    run_speed_views(
        spark, topic, tables, work_dir(spark, "offsets"), ntz(STAMP), per_trigger=per_tick,
        views=views).awaitTermination()
    return tables


def _summed(spark: SparkSession, tables: Tables, key: str) -> DataFrame:
    return read_speed(spark, tables, key).groupBy(key, "created_at").agg(
        F.sum("total_customer").alias("total_customer"))


def _count_sql(key: str) -> str:
    return (f"SELECT coalesce({key}, 'Unknown') AS {key}, TIMESTAMP '{STAMP}' AS created_at, "
            f"count(*) AS total_customer FROM sales GROUP BY coalesce({key}, 'Unknown')")


@query("speed_count_by_property_type", on_sales(_count_sql("property_type")))
def speed_count_by_property_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summed(spark, _speed(spark, sf_dir, "property_type"), "property_type")


@query("speed_count_by_town", on_sales(_count_sql("town")))
def speed_count_by_town(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summed(spark, _speed(spark, sf_dir, "town"), "town")


@query("speed_totals", on_sales(
    f"SELECT TIMESTAMP '{STAMP}' AS created_at, round(sum(sales_ratio), 4) AS total_sales_ratio, "
    f"round(sum(sale_amount), 2) AS total_sale_amount, count(*) AS total_customer "
    f"FROM sales WHERE {COMPLETE}"))
def speed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = read_speed(spark, _speed(spark, sf_dir, "totals"), "totals")
    return partials.groupBy("created_at").agg(
        F.round(F.sum("total_sales_ratio"), 4).alias("total_sales_ratio"),
        F.round(F.sum("total_sale_amount"), 2).alias("total_sale_amount"),
        F.sum("total_customer").alias("total_customer"))


@query("stream_speed_views", on_sales(
    "SELECT 'property_type' AS view, coalesce(property_type, 'Unknown') AS label, "
    "count(*) AS total_customer, CAST(NULL AS DOUBLE) AS total_sale_amount FROM sales GROUP BY 2 "
    "UNION ALL SELECT 'town', coalesce(town, 'Unknown'), count(*), NULL FROM sales GROUP BY 2 "
    f"UNION ALL SELECT 'totals', 'all', count(*), round(sum(sale_amount), 2) FROM sales "
    f"WHERE {COMPLETE}"))
def stream_speed_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _speed(spark, sf_dir, *SPEED_VIEWS)
    none = F.lit(None).cast("double").alias("total_sale_amount")

    def keyed(view: str) -> DataFrame:
        return _summed(spark, tables, view).select(
            F.lit(view).alias("view"), F.col(view).alias("label"), "total_customer", none)

    total = read_speed(spark, tables, "totals").agg(
        F.lit("totals").alias("view"), F.lit("all").alias("label"),
        F.sum("total_customer").alias("total_customer"),
        F.round(F.sum("total_sale_amount"), 2).alias("total_sale_amount"))
    return keyed("property_type").unionByName(keyed("town")).unionByName(total)


@query("stream_publish", on_sales(
    "SELECT serial_number, strftime(date_recorded, '%Y-%m-%d') AS date_recorded, town, "
    "sale_amount FROM sales"))
def stream_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, per_tick = feed_parts(spark, sf_dir)
    out = work_dir(spark, "published")
    publish(stream_sales(spark, parts, files_per_trigger=per_tick), Topic.folder(out),
            work_dir(spark, "offsets"), every=None).awaitTermination()
    return decode(spark.read.parquet(out)).select(
        "serial_number", "date_recorded", "town", "sale_amount")


@query("stream_to_lake", on_sales(digest_sql(
    more=f", TIMESTAMP '{STAMP}' AS created_at")))
def stream_to_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, per_tick = message_topic(spark, sf_dir)
    tables = Tables(work_dir(spark, "ingest"))
    run_lake(spark, topic, tables, work_dir(spark, "offsets"), ntz(STAMP),
             per_trigger=per_tick).awaitTermination()
    rows = read_lake(spark, tables)
    return digest(rows).withColumn("created_at", rows.agg(F.max("created_at")).scalar())


@query("processing_trigger", on_sales(digest_sql()))
def processing_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, per_tick = feed_parts(spark, sf_dir)
    out = work_dir(spark, "published")
    running = publish(
        stream_sales(spark, parts, files_per_trigger=per_tick), Topic.folder(out),
        work_dir(spark, "offsets"), every="200 milliseconds")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return digest(cast_sales(decode(spark.read.parquet(out)), schemas.SALE))


@query("offset_checkpoint", on_sales(digest_sql()))
def offset_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, per_tick = message_topic(spark, sf_dir)
    tables, offsets = Tables(work_dir(spark, "ingest")), work_dir(spark, "offsets")

    def write(df: DataFrame, batch_id: int) -> None:
        write_batch(df, tables.lake, batch_id, schemas.LAKE)

    def write_and_fail(df: DataFrame, batch_id: int) -> None:
        write(df, batch_id)
        if batch_id == 2:  # after the rows are stored, before the batch is committed
            raise RuntimeError("simulated failure")

    def run(action) -> None:
        rows = to_lake_rows(subscribe(spark, topic, per_trigger=per_tick), ntz(STAMP))
        for_each_batch(rows, action, offsets).awaitTermination()

    try:
        run(write_and_fail)
    except StreamingQueryException:
        pass  # expected; the next run takes up the same batch
    run(write)
    return digest(read_lake(spark, tables))


@query("two_publishers_one_topic", on_sales(digest_sql()))
def two_publishers_one_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, _ = feed_parts(spark, sf_dir)
    topic = Topic.folder(work_dir(spark, "shared-topic"))
    for half in (0, 1):  # each with a checkpoint, and so with batch numbers, of its own
        mine = stream_sales(spark, parts).filter(F.col("serial_number") % 2 == half)
        publish(mine, topic, work_dir(spark, "offsets"), every=None).awaitTermination()
    tables = Tables(work_dir(spark, "ingest"))
    run_lake(spark, topic, tables, work_dir(spark, "offsets"), ntz(STAMP)).awaitTermination()
    return digest(read_lake(spark, tables))


@query("two_streams_one_lake", on_sales(digest_sql()))
def two_streams_one_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, _ = feed_parts(spark, sf_dir)
    tables = Tables(work_dir(spark, "ingest"))
    for half in (0, 1):
        topic = Topic.folder(work_dir(spark, "topic"))
        mine = stream_sales(spark, parts).filter(F.col("serial_number") % 2 == half)
        publish(mine, topic, work_dir(spark, "offsets"), every=None).awaitTermination()
        run_lake(spark, topic, tables, work_dir(spark, "offsets"), ntz(STAMP)).awaitTermination()
    return digest(read_lake(spark, tables))


@query("quarantine_messages", on_sales(
    "SELECT 'stored' AS kind, count(*) AS n FROM sales WHERE serial_number % 10 <> 1 "
    "UNION ALL SELECT 'quarantined', count(*) FROM sales WHERE serial_number % 10 = 1"))
def quarantine_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is either in the lake or in quarantine: here those cut off are."""
    broken, per_tick = damaged_topic(spark, sf_dir)
    tables, out = Tables(work_dir(spark, "ingest")), work_dir(spark, "quarantine")
    run_ingest(spark, broken, tables, work_dir(spark, "offsets"), ntz(STAMP),
               per_trigger=per_tick).awaitTermination()
    run_quarantine(spark, broken, out, work_dir(spark, "offsets")).awaitTermination()
    stored = read_lake(spark, tables).agg(F.lit("stored").alias("kind"), F.count("*").alias("n"))
    refused = spark.read.parquet(out).filter("dropped")
    return stored.union(refused.agg(F.lit("quarantined").alias("kind"), F.count("*").alias("n")))
