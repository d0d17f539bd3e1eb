"""Files that appear once, the log of micro-batches, compaction, and releases."""

import datetime
import pathlib
import threading

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from salesflow import schemas
from salesflow.functions.cleaning import ntz
from salesflow.functions.wire import encode
from salesflow.operators import aggregates as A
from salesflow.operators import features as X
from salesflow.operators import quality as Q
from salesflow.operators import regression as R
from salesflow.operators import serving as S
from salesflow.plans import flows
from salesflow.sources import log as L
from salesflow.sources.tables import publish_view, read_view, released_run
from salesflow.sources.testdata import sales
from salesflow.streaming import compaction
from salesflow.streaming.bus import Topic, for_each_batch, subscribe
from salesflow.streaming.layers import (
    MicroBatch, Snapshot, Tables, read_lake, read_quarantine, run_ingest, stream_id)

DAY, NOW = datetime.datetime(2020, 1, 1), datetime.timedelta(0)
SHAPES = {k: Q.Suite("shape", (Q.columns_ordered(*v.names),)) for k, v in flows.BATCH_VIEWS.items()}


def messages(spark, first, last):
    rows = spark.range(first, last).select(
        F.col("id").alias("serial_number"), F.concat(F.lit("T"), F.col("id") % 3).alias("town"),
        F.lit("Condo").alias("property_type"), F.lit(1.0).alias("sale_amount"), F.lit(0.5).alias("sales_ratio"))
    return encode(rows).union(spark.createDataFrame([("broken",)], "value string"))


def batch(spark, tables, number, at, stream="one", rows=10):
    stamped = messages(spark, rows * number, rows * (number + 1)).withColumn(
        "created_at", ntz(at.isoformat(sep=" ")))
    return MicroBatch(stamped, number, tables, stream, L.CommitLog.registration(stream))


def serials(df):
    return sorted(r.serial_number for r in df.select("serial_number").collect())


def state_of(spark, tables):
    """What a reader sees: rows, partials, quarantined lines."""
    s = Snapshot.take(spark, tables)
    lake = s.lake()
    return (serials(lake), s.speed("town").agg(F.sum("total_customer")).first()[0] or 0,
            s.speed("totals").agg(F.sum("total_customer")).first()[0] or 0, s.quarantine().count(), s.log.counts(),
            sorted(map(tuple, lake.select("stream", "batch_id", "created_at").distinct().collect())))


# --- files ---------------------------------------------------------------------------


@pytest.mark.parametrize("way", ["link", "rename"])
def test_one_of_many_writers_wins(spark, folder, monkeypatch, way):
    if way == "rename":  # the way of other file systems; the local one is not atomic, so one after the other
        monkeypatch.setattr(L.os, "link", lambda a, b: None)
        place = folder("x")
        jvm = spark._jvm.org.apache.hadoop.fs.Path
        files, target = L._files(spark, place)
        target = files.makeQualified(target)
        for expected in (True, False, False):
            written = files.makeQualified(jvm(folder("tmp")))
            files.create(written, True).close()
            assert L._renamed(spark, written, target) is expected
        return
    path, won = folder("x") + "/n.json", []

    def write(i):
        if L.put_if_absent(spark, path, {"writer": i}):
            won.append(i)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(16)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and L.read_json(spark, path) == {"writer": won[0]}
    assert L.names(spark, path.rpartition("/")[0]) == ["n.json"]


def test_versions_follow_one_another(spark, folder):
    path = folder("v")
    assert L.latest(spark, path) == (0, None)
    for n in range(12):
        assert L.publish(spark, path, {"n": n}, n) == n + 1
    assert L.latest(spark, path) == (12, {"n": 11})
    with pytest.raises(L.Conflict):
        L.publish(spark, path, {"n": "late"}, 11)


def test_runs_of_numbers():
    assert L.intervals({"a": [3, 1, 2, 9, 9], "b": []}) == {"a": [[1, 3], [9, 9]], "b": []}
    joined = compaction._joined({"a": [[0, 4], [8, 9]]}, {"a": [[5, 6]], "b": [[1, 1]]})
    assert joined == {"a": [[0, 6], [8, 9]], "b": [[1, 1]]}
    assert L.within(joined, "a", 6) and not L.within(joined, "a", 7) and not L.within(joined, "c", 1)


# --- the log ----------------------------------------------------------------------------


def test_a_reader_between_any_two_steps_sees_whole_batches(spark, folder):
    tables = Tables(folder("t"))
    L.CommitLog(spark, tables.root).open_stream("one", DAY)
    for number in (0, 1):
        made = batch(spark, tables, number, DAY + datetime.timedelta(days=number))
        before = state_of(spark, tables)
        assert before[:5] == (list(range(10 * number)), 10 * number, 10 * number, number, (10 * number, number))
        for step in made.steps()[:-1]:
            step()
            assert state_of(spark, tables) == before
        made.enter()
        assert state_of(spark, tables)[:2] == (list(range(10 * number + 10)), 10 * number + 10)


def test_a_stored_batch_is_not_written_again(spark, folder):
    tables = Tables(folder("t"))
    L.CommitLog(spark, tables.root).open_stream("one", DAY)
    batch(spark, tables, 0, DAY).run()
    seen = state_of(spark, tables)
    files = set(read_lake(spark, tables).inputFiles())
    batch(spark, tables, 0, DAY).run()
    assert state_of(spark, tables) == seen and set(read_lake(spark, tables).inputFiles()) == files


def test_frontier_of_streams_that_come_and_go(spark, folder):
    tables = Tables(folder("t"))
    log, second = L.CommitLog(spark, tables.root), datetime.timedelta(seconds=1)
    step = datetime.timedelta(microseconds=1)

    def frontier():
        return log.state().frontier()

    assert not log.exists() and frontier() is None and flows.closed_cutoff(spark, tables) is None
    log.open_stream("one", DAY)
    assert frontier() == DAY  # opened, nothing stored yet
    batch(spark, tables, 0, DAY + 5 * second).run()
    assert frontier() == DAY + 5 * second + step
    log.open_stream("two", DAY + 6 * second)
    batch(spark, tables, 1, DAY + 9 * second).run()
    assert frontier() == DAY + 6 * second  # the first batch of "two" may still carry that stamp
    batch(spark, tables, 0, DAY + 7 * second, "two").run()
    assert frontier() == DAY + 7 * second + step
    log.open_stream("two", DAY + 60 * second)  # a restart: an unfinished batch keeps its old stamp
    assert frontier() == DAY + 7 * second + step
    flows.retire_stream(spark, tables, "two")
    assert frontier() == DAY + 9 * second + step
    log.close_stream("one")
    assert frontier() == DAY + 9 * second + step
    log.open_stream("one", DAY + 30 * second)
    assert frontier() == DAY + 30 * second
    with pytest.raises(ValueError, match="no stream"):
        log.close_stream("never")


def test_streams_with_an_unfinished_batch(spark, folder):
    path, checkpoint = folder("topic"), folder("o")
    messages(spark, 0, 5).write.parquet(path)
    tables = Tables(folder("t"))
    log = L.CommitLog(spark, tables.root)
    log.open_stream(checkpoint, DAY)

    def fail(df, batch_id):
        raise RuntimeError("simulated failure")

    with pytest.raises(StreamingQueryException):
        for_each_batch(subscribe(spark, Topic.folder(path)), fail, checkpoint).awaitTermination()
    with pytest.raises(ValueError, match="unfinished"):
        log.close_stream(checkpoint)
    flows.retire_stream(spark, tables, checkpoint)
    with pytest.raises(ValueError, match="another checkpoint"):
        run_ingest(spark, Topic.folder(path), tables, checkpoint)
    run_ingest(spark, Topic.folder(path), tables, folder("o")).awaitTermination()
    assert serials(read_lake(spark, tables)) == [0, 1, 2, 3, 4]
    assert [(r.value, r.dropped) for r in read_quarantine(spark, tables).collect()] == [("broken", True)]


def test_the_speed_layer_closes_its_stream(spark, sf_dir, folder):
    feed, root = folder("feed"), folder("root")
    sales(spark, sf_dir, *schemas.SALE.names).limit(50).write.parquet(feed)
    tables = flows.speed_layer(spark, feed, root)
    flows.run_batch(spark, tables, "r", suites=SHAPES)
    assert flows.read_batch(spark, root, "town").agg(F.sum("total_customer")).first()[0] == 50
    sales(spark, sf_dir, *schemas.SALE.names).limit(8).write.mode("append").parquet(feed)
    flows.speed_layer(spark, feed, root)
    views = flows.Views.open(spark, root)
    served = S.serve_by_key(views.batch["town"], views.speed["town"], "town", flows.now())
    assert served.agg(F.sum("total_customer")).first()[0] == 58


def test_the_log_survives_a_failure_before_its_entry(spark, folder):
    """The third batch is stored in part, fails, and is repeated by the next run."""
    path, checkpoint, tables = folder("topic"), folder("o"), Tables(folder("t"))
    spark.range(40).select(F.to_json(F.struct(F.col("id").alias("serial_number"))).alias("value")).repartition(
        4).write.parquet(path)
    registration = L.CommitLog(spark, tables.root).open_stream(checkpoint, DAY)

    def run(fail_after):
        def write(df, batch_id):
            stamped = df.withColumn("created_at", ntz(f"2020-01-0{batch_id + 1} 00:00:00"))
            made = MicroBatch(stamped, batch_id, tables, stream_id(df.sparkSession, checkpoint), registration)
            if batch_id == 2 and fail_after is not None:
                for step in made.steps()[:fail_after]:
                    step()
                raise RuntimeError("simulated failure")
            made.run()
        for_each_batch(subscribe(spark, Topic.folder(path), per_trigger=1), write, checkpoint).awaitTermination()

    for fail_after in (1, 3, 4):  # after the lake, after the speed views, after the entry
        with pytest.raises(StreamingQueryException):
            run(fail_after)
        flows.compact(spark, tables)
    run(None)
    assert serials(read_lake(spark, tables)) == list(range(40))
    assert Snapshot.take(spark, tables).speed("totals").count() == 4


# --- compaction -----------------------------------------------------------------------------


@pytest.mark.parametrize("when", ["before", "between", "during", "after"])
def test_compaction_around_a_repeated_batch(spark, folder, monkeypatch, when):
    tables, day = Tables(folder("t")), datetime.timedelta(days=1)
    L.CommitLog(spark, tables.root).open_stream("one", DAY)
    for number in range(6):
        batch(spark, tables, number, DAY + number // 3 * day + number * datetime.timedelta(seconds=5)).run()
    last = batch(spark, tables, 6, DAY + 4 * day)
    if when == "before":
        flows.compact(spark, tables)
    steps = last.steps()
    steps[0]()
    if when == "between":
        flows.compact(spark, tables)
    for step in steps[1:]:
        step()
    seen = state_of(spark, tables)
    if when == "during":  # a batch is entered while the unit is being written
        write = compaction.write_merged

        def interrupted(*args, **kwargs):
            write(*args, **kwargs)
            batch(spark, tables, 6, DAY + 4 * day).run()
            assert state_of(spark, tables) == seen

        monkeypatch.setattr(compaction, "write_merged", interrupted)
        assert flows.compact(spark, tables) == 1
    batch(spark, tables, 2, DAY).run()  # repeated, whether it was merged or not
    if when != "during":
        assert flows.compact(spark, tables) == (1 if when == "after" else 2)
    assert state_of(spark, tables) == seen
    files = Snapshot.take(spark, tables).lake().filter(f"created_date <= '{(DAY + day).date()}'").select(
        "created_date", F.input_file_name().alias("f")).distinct()
    assert files.count() == 2  # one per closed date
    flows.sweep(spark, tables, NOW)
    batch(spark, tables, 2, DAY).run()
    assert state_of(spark, tables) == seen
    assert L.names(spark, f"{tables.lake}/created_date=2020-01-01") == ["stream=_merged"]
    assert flows.compact(spark, tables) is None and flows.sweep(spark, tables, NOW) == 0


def test_a_late_batch_is_merged_into_its_date(spark, folder):
    tables = Tables(folder("t"))
    log = L.CommitLog(spark, tables.root)
    for stream in ("one", "two"):
        log.open_stream(stream, L.LOWEST)
    batch(spark, tables, 0, DAY).run()
    batch(spark, tables, 1, DAY + datetime.timedelta(days=2)).run()
    assert flows.compact(spark, tables) is None  # "two" may still bring anything
    log.close_stream("two")
    assert flows.compact(spark, tables) == 1
    batch(spark, tables, 7, DAY, "two").run()
    seen = state_of(spark, tables)
    assert seen[0] == [*range(20), *range(70, 80)]
    assert flows.compact(spark, tables) == 2 and state_of(spark, tables) == seen
    flows.sweep(spark, tables, NOW)
    assert state_of(spark, tables) == seen
    assert len(L.names(spark, f"{tables.lake}/created_date=2020-01-01/stream=_merged")) == 1


def test_of_two_compactions_one_publishes(spark, folder, monkeypatch):
    tables = Tables(folder("t"))
    L.CommitLog(spark, tables.root).open_stream("one", DAY)
    for number in range(3):
        batch(spark, tables, number, DAY + datetime.timedelta(days=number)).run()
    seen, write, inner = state_of(spark, tables), compaction.write_merged, []

    def overtaken(*args, **kwargs):
        if not inner:
            inner.append(1)
            flows.compact(spark, tables)
        write(*args, **kwargs)

    monkeypatch.setattr(compaction, "write_merged", overtaken)
    with pytest.raises(L.Conflict):
        flows.compact(spark, tables)
    assert state_of(spark, tables) == seen
    flows.sweep(spark, tables, NOW)
    assert state_of(spark, tables) == seen
    assert len(L.names(spark, f"{tables.lake}/created_date=2020-01-01/stream=_merged")) == 1


def test_snapshots_read_only_their_folders(spark, folder):
    tables = Tables(folder("t"))
    L.CommitLog(spark, tables.root).open_stream("one", DAY)
    for number in range(3):
        batch(spark, tables, number, DAY + datetime.timedelta(days=number)).run()
    flows.compact(spark, tables)
    lake = Snapshot.take(spark, tables).lake()
    plan = lake._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "Join" not in plan and "Filter " not in plan.replace("PartitionFilters", "")
    assert serials(lake) == list(range(30))


def test_a_young_folder_is_not_swept(spark, folder):
    tables = Tables(folder("t"))
    L.CommitLog(spark, tables.root).open_stream("one", DAY)
    for number in range(2):
        batch(spark, tables, number, DAY + datetime.timedelta(days=number)).run()
    running = read_lake(spark, tables)
    flows.compact(spark, tables)
    assert flows.sweep(spark, tables) == 0
    assert serials(running) == list(range(20))


def test_batch_and_speed_after_compaction(spark, folder):
    tables = Tables(folder("t"))
    L.CommitLog(spark, tables.root).open_stream("one", DAY)
    for number in range(4):
        batch(spark, tables, number, DAY + datetime.timedelta(days=number)).run()
    flows.batch_layer(read_lake(spark, tables), tables.root, "r", ntz("2020-01-02 00:00:00"), suites=SHAPES)
    flows.compact(spark, tables)
    views = flows.Views.open(spark, tables.root)
    served = S.serve_by_key(views.batch["town"], views.speed["town"], "town", ntz("2021-01-01 00:00:00"))
    want = {r.town: r.total_customer for r in A.count_by(read_lake(spark, tables), "town").collect()}
    assert {r.town: r.total_customer for r in served.collect()} == want and sum(want.values()) == 40


# --- releases --------------------------------------------------------------------------------


def test_equal_clocks_do_not_matter(spark, folder):
    view, schema = folder("view"), schemas.BATCH_BY_TOWN

    def counts_of(n):
        return spark.createDataFrame([("T", n)], "town string, total_customer long").withColumns(
            {"started_at": ntz("2020-01-01 00:00:00"), "ended_at": ntz("2020-01-01 00:00:00")})

    for n in range(1, 5):
        publish_view(counts_of(n), view, f"r{n}", schema)
    assert released_run(spark, view) == "r4"
    with pytest.raises(L.Conflict):
        publish_view(counts_of(9), view, "slow", schema, lambda _: publish_view(counts_of(7), view, "fast", schema))
    assert [r.total_customer for r in read_view(spark, view, schema).collect()] == [7]


def test_a_model_is_released_with_its_features(spark, sf_dir, folder, monkeypatch):
    lake, path = sales(spark, sf_dir), folder("model")
    whole = (ntz("1900-01-01 00:00:00"), ntz("2030-01-01 00:00:00"))
    flows.retrain(lake, *whole, path=path)

    def predictions():
        return sorted(r[0] for r in flows.score(path, lake).select(R.PREDICTION).collect())

    first, half = predictions(), lake.filter("serial_number % 2 = 0")
    save = X.save_features

    def fails(*_):
        raise OSError("simulated failure")

    monkeypatch.setattr(X, "save_features", fails)
    with pytest.raises(OSError):
        flows.retrain(half, *whole, path=path)
    assert predictions() == first
    monkeypatch.setattr(X, "save_features", save)
    flows.retrain(half, *whole, path=path)
    assert predictions() != first and L.latest(spark, f"{path}/versions")[0] == 2


def test_bytes_bound_a_micro_batch_at_any_size(spark, folder):
    """Ten times the input: ten times the micro-batches, none of them larger."""
    sizes = {}
    for times in (1, 10):
        path, out, seen = folder("topic"), folder("out"), []
        spark.range(400 * times).selectExpr("repeat(cast(id as string), 50) AS value").repartition(4 * times).write.parquet(path)
        stored = [p.stat().st_size for p in pathlib.Path(path).glob("*.parquet")]
        messages = subscribe(spark, Topic.folder(path), bytes_per_trigger=2 * max(stored))
        for_each_batch(messages, lambda rows, _: seen.append(rows.count()), out).awaitTermination()
        assert sum(seen) == 400 * times
        sizes[times] = seen
    assert len(sizes[10]) >= 8 * len(sizes[1]) and max(sizes[10]) <= 1.5 * max(sizes[1])
    with pytest.raises(ValueError):
        subscribe(spark, Topic.folder(folder("t")), per_trigger=1, bytes_per_trigger=1)
    with pytest.raises(ValueError):
        subscribe(spark, Topic.kafka("h:1", "t"), bytes_per_trigger=1)
