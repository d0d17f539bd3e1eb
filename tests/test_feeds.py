"""The files that stand for a feed, and how the derived sales are joined."""

import shutil

import pytest
from pyspark.sql import functions as F

from salesflow.catalog import base, lake, scans, streams
from salesflow.sources.files import read_sales, split_by_date
from salesflow.sources.testdata import sales
from salesflow.streaming.bus import part_numbers, release_parts


@pytest.fixture()
def feed(spark, sf_dir, monkeypatch):
    """Feeds of their own, whose files grow until the input makes two micro-batches, up to 500 rows."""
    for name, value in {"_FEEDS": {}, "PART_ROWS": 10, "MOST_PART_ROWS": 500, "TICKS": 2}.items():
        monkeypatch.setattr(base, name, value)
    return sales(spark, sf_dir).count()


def _largest(df):
    return df.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]


def test_part_rows_follow_the_input_between_two_bounds(monkeypatch):
    monkeypatch.setattr(base, "PART_ROWS", 20_000)
    assert base.part_rows(0) == base.part_rows(600_000) == 20_000
    tick = base.FILES_PER_TICK
    for rows in (3_600_000, 36_000_000):  # ten times the rows, as many micro-batches
        assert 15 <= rows / base.part_rows(rows) / tick <= base.TICKS
    # beyond, micro-batches are bounded and their number grows with the input
    assert base.part_rows(216_000_000) == base.part_rows(10**10) == base.MOST_PART_ROWS


def test_feed_makes_a_bounded_number_of_files(spark, sf_dir, feed):
    parts, per_tick = base.feed_parts(spark, sf_dir)
    stored = read_sales(spark, parts)
    assert stored.count() == feed
    assert len(stored.inputFiles()) == -(-feed // base.part_rows(feed)) <= 2 * per_tick
    topic, per_tick = base.message_topic(spark, sf_dir)
    messages = spark.read.parquet(topic.options["path"])
    assert messages.count() == feed
    assert _largest(messages) <= base.part_rows(feed)


def test_messages_are_stored_in_bounded_files_without_a_shuffle(spark, sf_dir, feed, monkeypatch):
    monkeypatch.setattr(base, "MOST_PART_ROWS", 100)
    stored = base.store_messages(spark.range(5000).repartition(1).select(F.col("id").cast("string").alias("value")), 5000)
    messages = spark.read.parquet(stored.options["path"])
    assert (messages.distinct().count(), _largest(messages)) == (5000, 100)


@pytest.mark.parametrize("module, name", [(streams, "quarantine_messages"), (lake, "message_accounts")])
def test_damaged_messages_come_in_several_micro_batches(spark, sf_dir, feed, monkeypatch, module, name):
    seen = []
    run = module.run_ingest

    def counted(*args, **how):
        running = run(*args, **how)
        seen.append(running)
        return running

    monkeypatch.setattr(module, "run_ingest", counted)
    monkeypatch.setattr(base, "MOST_PART_ROWS", 200)
    base.QUERIES[name](spark, sf_dir).collect()
    assert sum(p["numInputRows"] > 0 for p in seen[0].recentProgress) > 2


def test_rows_of_lineitem_meet_each_table_once(spark, sf_dir):
    """Customers are joined to their orders before the orders are joined to lineitem."""
    lines = sales(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().splitlines()

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    at = next(i for i, line in enumerate(lines) if "Join" in line and "c_custkey" in line)
    below = []
    for line in lines[at + 1:]:
        if depth(line) <= depth(lines[at]):
            break
        below.append(line)
    assert any("o_custkey" in line for line in below)
    assert not any("l_orderkey" in line for line in below)


def test_replay_with_a_range_that_left_no_file(spark, sf_dir, folder, monkeypatch):
    whole, parts = folder("whole"), folder("parts")
    made = sales(spark, sf_dir).drop("created_at")
    split_by_date(made, 6, whole)
    shutil.copytree(whole, parts, ignore=shutil.ignore_patterns("part-00002-*", ".*"))
    left = read_sales(spark, parts)
    assert part_numbers(left) == [0, 1, 3, 4, 5]
    monkeypatch.setattr(scans, "feed_parts", lambda *_: (parts, 2))
    found = scans.paced_replay(spark, sf_dir).agg(F.sum("n"), F.bool_and("in_order")).first()
    assert tuple(found) == (left.count(), True)
    with pytest.raises(FileNotFoundError):
        release_parts(spark, parts, folder("watched"), [1, 2])


def test_published_messages_are_compressed_well(spark, sf_dir, feed, monkeypatch):
    made = []
    work_dir = streams.work_dir
    monkeypatch.setattr(streams, "work_dir", lambda *a: made.append(work_dir(*a)) or made[-1])
    assert streams.stream_publish(spark, sf_dir).count() == feed
    files = spark.read.parquet(made[0]).inputFiles()
    assert files and all(name.endswith(".zstd.parquet") for name in files)
