"""What large tables leave on disk while a query runs: rounds, shuffles that go, feeds that are removed."""

import time
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from salesflow import session
from salesflow.catalog import base, lake, scans
from salesflow.sources import files, log, testdata
from salesflow.sources.tables import MERGED
from salesflow.streaming.layers import MicroBatch, Tables

DAY = date(2001, 1, 1)


@pytest.fixture()
def large(monkeypatch):
    """Every table counts as large, and nothing is there yet."""
    monkeypatch.setattr(session, "ROUND_BYTES", 1)
    monkeypatch.setattr(testdata, "ROUND_BYTES", 1)
    monkeypatch.setattr(testdata, "_STAGED", {})
    monkeypatch.setattr(base, "_FEEDS", {})


def _dated(spark, folder):
    """Rows without a date, a hot date, and other dates; stored in no order."""
    days = [None] * 300 + [DAY] * 700 + [DAY + timedelta(days=n % 50) for n in range(1000)]
    path = folder("rows")
    spark.createDataFrame([(n, d) for n, d in enumerate(days)], "n long, date_recorded date").withColumn(
        "twice", F.explode(F.array(F.lit(1), F.lit(1)))).orderBy(F.xxhash64("n")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("n, rounds", [(8, 4), (3, 1), (30, 8)])
def test_a_large_table_is_split_in_rounds(spark, folder, large, monkeypatch, n, rounds):
    rows, path, seen = _dated(spark, folder), folder("parts"), []
    whole = files.range_split

    def counted(df, parts, *by, **how):
        seen.append((parts, df.count()))
        return whole(df, parts, *by, **how)

    monkeypatch.setattr(files, "range_split", counted)
    files.split_by_date(rows, n, path)
    assert len(seen) == rounds and sum(parts for parts, _ in seen) == n
    assert sum(count for _, count in seen) == 4000
    assert max(count for _, count in seen) < 4000 / rounds * 1.5
    parts = spark.read.parquet(path)
    assert len(parts.inputFiles()) == n and not log.names(spark, f"{path}/../_parts*")
    assert Counter(parts.collect()) == Counter(rows.collect())
    number = files.part_number(F.col("_metadata.file_path"))
    ordered = parts.select(number.alias("part"), F.col("_metadata.row_index").alias("at"), "date_recorded").orderBy(
        "part", "at").collect()
    found = [r.date_recorded or date.min for r in ordered]
    assert found == sorted(found)
    assert [p // 1_000_000 for p in sorted({r.part for r in ordered})] == list(range(n))


def test_the_sales_are_joined_in_rounds(spark, sf_dir, large):
    stored = spark.read.parquet(testdata.sales_files(spark, sf_dir))
    whole = testdata.sales(spark, sf_dir).drop("created_at")
    assert Counter(stored.select(whole.columns).withColumn("sales_ratio", F.col("sales_ratio").cast("string")).collect()) == \
        Counter(whole.withColumn("sales_ratio", F.col("sales_ratio").cast("string")).collect())
    counts = [testdata.sales(spark, sf_dir, share=(i, 4)).count() for i in range(4)]
    assert sum(counts) == whole.count() and max(counts) < whole.count() / 2


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark, folder):
    rows, before = _dated(spark, folder), _shuffle_files(spark)
    kept = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    files.split_by_date(rows, 4, folder("parts"))
    for _ in range(50):  # removed in the background
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == kept


def test_large_feeds_are_removed_when_the_next_is_made(spark, sf_dir, large, monkeypatch):
    gone = []
    for module in (base, testdata):
        monkeypatch.setattr(module, "remove", lambda s, path: gone.append(path) or log.remove(s, path))
    topic, _ = base.damaged_topic(spark, sf_dir)
    assert {path.rpartition("/")[2].split("-")[0] for path in gone} == {"sales", "parts", "topic"}
    assert not any(log.exists(spark, path) for path in gone)
    assert spark.read.parquet(topic.options["path"]).count() == testdata.sales(spark, sf_dir).count()


def test_feeds_that_a_query_has_stay(spark, sf_dir, large):
    parts, _ = base.feed_parts(spark, sf_dir)
    base.message_topic(spark, sf_dir)
    assert log.exists(spark, parts) and base.feed_parts(spark, sf_dir)[0] == parts


def test_micro_batches_are_not_cached_on_disk(spark, folder, monkeypatch):
    levels, persist = [], DataFrame.persist

    def noted(self, level=None):
        levels.append(level)
        return persist(self, level)

    monkeypatch.setattr(DataFrame, "persist", noted)
    tables = Tables(folder("layers"))
    registration = log.CommitLog(spark, tables.root).open_stream("one", datetime(1997, 1, 1))
    messages = spark.range(10).select(
        F.format_string('{"serial_number":%d}', "id").alias("value"), F.lit("1997-01-01").cast("timestamp_ntz").alias("created_at"))
    MicroBatch(messages, 0, tables, registration, registration).run()
    assert len(levels) == 1 and not levels[0].useDisk
    MicroBatch(messages, 1, tables, registration, registration, parts=("lake",)).run()
    assert len(levels) == 1  # read once: no cache


def test_a_date_has_one_merged_unit_at_a_time(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(base, "_FEEDS", {})
    monkeypatch.setattr(base, "PART_ROWS", 50)  # many micro-batches
    units, compact = [], lake.flows.compact

    def counted(session_, tables, *args):
        out = compact(session_, tables, *args)
        for day in log.names(spark, tables.lake):
            units.append(len(log.names(spark, f"{tables.lake}/{day}/stream={MERGED}")))
        for name in spark.read.option("recursiveFileLookup", "true").parquet(tables.lake).inputFiles():
            assert name.endswith(".zstd.parquet")
        return out

    monkeypatch.setattr(lake.flows, "compact", counted)
    lake.lake_merged_midway(spark, sf_dir).collect()
    assert max(units) <= 2  # the one that a date has had, and the one just merged


def test_lines_of_a_csv_in_many_small_files(spark, sf_dir, monkeypatch):
    """A task that reads several files meets several headers."""
    monkeypatch.setattr(scans, "MOST_PART_ROWS", 50)
    names = spark.read.text(scans.raw_csv(spark, sf_dir)).inputFiles()
    rows = testdata.sales(spark, sf_dir, "serial_number").count()
    assert len(names) >= rows / 50 and all(name.endswith(".csv.gz") for name in names)
    found = {r.kind: r.n for r in scans.quarantine_csv(spark, sf_dir).collect()}
    last = {r["last"]: r["count"] for r in testdata.sales(spark, sf_dir, "serial_number").groupBy(
        (F.col("serial_number") % 10).alias("last")).count().collect()}
    assert found == {"dropped": last[1], "damaged": last[2], "whole": rows - last[1] - last[2]}
