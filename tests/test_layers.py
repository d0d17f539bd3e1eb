"""Batch, speed and serving: whatever the split, the merged result is the whole."""

import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from salesflow import schemas
from salesflow.functions.cleaning import ntz
from salesflow.functions.wire import encode
from salesflow.operators import aggregates as A
from salesflow.operators import quality as Q
from salesflow.operators import serving as S
from salesflow.plans import flows
from salesflow.sources.files import (
    ingest_csv, part_number, range_split, read_sales, refused_lines, slice_rows, split_by_date)
from salesflow.sources.tables import (
    cluster_by_date, publish_view, read_since, read_table, read_view, released_run, write_batch, write_view)
from salesflow.sources.testdata import sales
from salesflow.streaming.bus import Topic, for_each_batch, publish, stream_sales, subscribe
from salesflow.streaming.layers import (
    Tables, arrival, read_lake, read_speed, run_ingest, run_lake, run_quarantine,
    run_speed_views, to_lake_rows, write_speed)

SUITES = {
    "property_type": Q.property_type_suite([*Q.PROPERTY_TYPES, "Vacant Land", ""]),
    "town": Q.town_suite(),
    "totals": Q.totals_suite(),
}
LATER = "2030-01-01 00:00:00"


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The derived sales as files."""
    path = str(tmp_path_factory.mktemp("sales") / "files")
    sales(spark, sf_dir, *schemas.SALE.names).write.parquet(path)
    return read_sales(spark, path)


def counts(df, key):
    return {r[key]: r.total_customer for r in df.groupBy(key).agg(
        F.sum("total_customer").alias("total_customer")).collect()}


# --- serving -------------------------------------------------------------------


@pytest.mark.parametrize("cutoff", ["1995-01-01 00:00:00", "1997-03-15 00:00:00",
                                    "1999-12-31 00:00:00", "2002-01-01 00:00:00"])
def test_batch_plus_speed_is_the_whole(spark, sf_dir, folder, cutoff):
    lake = sales(spark, sf_dir)
    before = lake.filter(F.col("created_at") < ntz(cutoff))
    tables = Tables(folder("t"))
    write_speed(lake.filter(F.col("created_at") >= ntz(cutoff))
                .withColumn("created_at", F.greatest(
                    F.trunc("date_recorded", "quarter").cast("timestamp_ntz"), ntz(cutoff))),
                0, tables)
    at = {"started_at": ntz(cutoff), "ended_at": ntz(cutoff)}
    for key in A.VIEW_KEYS:
        batch = A.count_by(before, key).withColumns(at)
        merged = S.serve_by_key(batch, read_speed_or_empty(spark, tables, key, cutoff), key, ntz(LATER))
        if before.isEmpty():  # without a batch run there is no cutoff to serve from
            assert merged.collect() == []
        else:
            assert counts(merged, key) == counts(A.count_by(lake, key), key)
    batch = A.totals(before).withColumns(at)
    row = S.serve_totals(
        batch, read_speed_or_empty(spark, tables, "totals", cutoff), ntz(LATER)).first()
    whole = A.totals(lake).first()
    assert row.total_customer == whole.total_customer
    assert row.total_sale_amount == pytest.approx(whole.total_sale_amount)
    assert row.average_sale_ratio == pytest.approx(
        whole.total_sales_ratio / whole.total_customer)


def read_speed_or_empty(spark, tables, view, cutoff):
    if cutoff >= "2002":  # nothing was written
        from salesflow.sources.tables import empty
        from salesflow.streaming.layers import SPEED_VIEWS
        return empty(spark, schemas.partitioned(SPEED_VIEWS[view]))
    return read_speed(spark, tables, view)


def _totals(spark, *rows):
    return spark.createDataFrame(
        [(r, a, n, datetime.datetime(2020, 1, d), datetime.datetime(2020, 1, d, 1))
         for r, a, n, d in rows],
        "total_sales_ratio double, total_sale_amount double, total_customer long, "
        "started_at timestamp_ntz, ended_at timestamp_ntz")


def _partials(spark, *rows):
    return spark.createDataFrame(
        [(r, a, n, datetime.datetime(2020, 1, d)) for r, a, n, d in rows],
        "total_sales_ratio double, total_sale_amount double, total_customer long, "
        "created_at timestamp_ntz")


def test_empty_speed_window_adds_nothing(spark):
    batch = _totals(spark, (1.0, 10.0, 2, 1), (2.0, 30.0, 4, 2))
    row = S.serve_totals(batch, _partials(spark), ntz(LATER)).first()
    assert tuple(row) == (2.0, 30.0, 4, 0.5)


def test_partials_before_the_cutoff_and_after_now_do_not_count(spark):
    batch = _totals(spark, (2.0, 30.0, 4, 2))
    speed = _partials(spark, (9.0, 9.0, 9, 1), (1.0, 5.0, 1, 2), (None, None, 0, 3),
                      (9.0, 9.0, 9, 4))
    row = S.serve_totals(batch, speed, ntz("2020-01-03 00:00:00")).first()
    assert (row.total_sales_ratio, row.total_sale_amount, row.total_customer) == (3.0, 35.0, 5)


def test_without_a_batch_run_there_is_no_answer(spark):
    row = S.serve_totals(_totals(spark), _partials(spark, (1.0, 5.0, 1, 2)), ntz(LATER)).first()
    assert tuple(row) == (None, None, None, None)
    assert S.latest(_totals(spark)).collect() == []


def test_batch_without_complete_rows(spark):
    batch = _totals(spark, (None, None, 0, 1))
    row = S.serve_totals(batch, _partials(spark, (1.0, 5.0, 1, 2)), ntz(LATER)).first()
    assert tuple(row) == (1.0, 5.0, 1, 1.0)


def test_only_the_newest_run_counts(spark):
    batch = spark.createDataFrame(
        [("a", 5, datetime.datetime(2020, 1, 1)), ("a", 7, datetime.datetime(2020, 1, 2))],
        "town string, total_customer long, started_at timestamp_ntz")
    speed = spark.createDataFrame(
        [("a", 1, datetime.datetime(2020, 1, 1)), ("b", 2, datetime.datetime(2020, 1, 3)),
         (None, 4, datetime.datetime(2020, 1, 3))],
        "town string, total_customer long, created_at timestamp_ntz")
    assert counts(S.serve_by_key(batch, speed, "town", ntz(LATER)), "town") == {"a": 7, "b": 2}


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("c", 1), ("b", 2), ("a", 1)], "town string, n long")
    assert [r.town for r in S.top_k(df, "n", "town", 2).collect()] == ["b", "a"]


# --- streams --------------------------------------------------------------------


def _topic(stored, folder, files):
    path = folder("topic")
    encode(stored).repartition(files).write.parquet(path)
    return Topic.folder(path)


@pytest.mark.parametrize("files", [1, 4, 7])
def test_any_split_into_micro_batches_gives_the_batch_result(spark, stored, folder, files):
    tables = Tables(folder("t"))
    run_ingest(spark, _topic(stored, folder, files), tables, folder("o"),
               per_trigger=1).awaitTermination()
    lake = read_lake(spark, tables)
    assert lake.select("batch_id").distinct().count() == files
    for key in A.VIEW_KEYS:
        expected = counts(A.count_by(stored, key), key)
        assert counts(read_speed(spark, tables, key), key) == expected
        assert counts(A.count_by(lake, key), key) == expected
    partial = read_speed(spark, tables, "totals").agg(
        F.sum("total_customer"), F.round(F.sum("total_sale_amount"), 2)).first()
    whole = A.totals(stored).first()
    assert tuple(partial) == (whole.total_customer, round(whole.total_sale_amount, 2))
    # one stamp per micro-batch, the same in the lake and in the partial views
    stamps = {(r.batch_id, r.created_at) for r in lake.select("batch_id", "created_at").collect()}
    assert stamps == {(r.batch_id, r.created_at) for r in read_speed(
        spark, tables, "totals").select("batch_id", "created_at").collect()}
    assert len(stamps) == files


def test_lake_and_separate_speed_views(spark, stored, folder):
    tables, topic = Tables(folder("t")), _topic(stored, folder, 3)
    run_lake(spark, topic, tables, folder("o"), per_trigger=1).awaitTermination()
    run_speed_views(spark, topic, tables, folder("o"), per_trigger=2,
                    views=("town",)).awaitTermination()
    assert read_lake(spark, tables).count() == stored.count()
    assert counts(read_speed(spark, tables, "town"), "town") == counts(
        A.count_by(stored, "town"), "town")


def test_failed_batch_is_repeated_not_lost(spark, stored, folder):
    topic, tables, offsets = _topic(stored, folder, 4), Tables(folder("t")), folder("o")

    def run(fail_at):
        def write(df, batch_id):
            write_batch(df, tables.lake, batch_id, schemas.LAKE)
            if batch_id == fail_at:
                raise RuntimeError("simulated failure")
        rows = to_lake_rows(subscribe(spark, topic, per_trigger=1))
        for_each_batch(rows, write, offsets).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(fail_at=2)
    run(fail_at=None)
    lake = read_lake(spark, tables)
    assert lake.count() == stored.count()
    assert sorted(r.batch_id for r in lake.select("batch_id").distinct().collect()) == [0, 1, 2, 3]
    assert lake.groupBy("batch_id").agg(F.countDistinct("created_at").alias("n")).filter(
        "n <> 1").isEmpty()
    run(fail_at=None)  # nothing new
    assert read_lake(spark, tables).count() == stored.count()


def test_new_messages_are_taken_up_later(spark, stored, folder):
    feed, root = folder("feed"), folder("root")
    stored.limit(10).write.parquet(feed)
    flows.speed_layer(spark, feed, root)
    stored.limit(7).write.mode("append").parquet(feed)
    tables = flows.speed_layer(spark, feed, root)
    assert read_lake(spark, tables).count() == 17
    assert counts(read_speed(spark, tables, "town"), "town").keys() >= {"Unknown"}


def test_unreadable_messages_go_to_quarantine(spark, folder):
    path, tables, out = folder("topic"), Tables(folder("t")), folder("q")
    spark.createDataFrame([('{"town":"T"}',), ("broken",), (None,)], "value string").coalesce(
        1).write.parquet(path)
    run_ingest(spark, Topic.folder(path), tables, folder("o")).awaitTermination()
    run_quarantine(spark, Topic.folder(path), out, folder("o")).awaitTermination()
    assert [r.town for r in read_lake(spark, tables).collect()] == ["T"]
    assert {r.value for r in spark.read.parquet(out).collect()} == {"broken", None}
    assert tuple(read_speed(spark, tables, "totals").select(
        "total_sales_ratio", "total_sale_amount", "total_customer").first()) == (None, None, 0)


def test_batch_of_only_unreadable_messages(spark, folder):
    path, tables = folder("topic"), Tables(folder("t"))
    spark.createDataFrame([("broken",)], "value string").write.parquet(path)
    run_ingest(spark, Topic.folder(path), tables, folder("o")).awaitTermination()


def test_processing_time_trigger(spark, stored, folder):
    feed, out = folder("feed"), folder("topic")
    stored.limit(20).write.parquet(feed)
    running = publish(stream_sales(spark, feed), Topic.folder(out), folder("o"), "100 milliseconds")
    running.processAllAvailable()
    stored.limit(5).write.mode("append").parquet(feed)
    running.processAllAvailable()
    running.stop()
    assert spark.read.parquet(out).count() == 25


def test_arrival_is_utc_whatever_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        stamp = spark.range(1).select(arrival().alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    assert abs((now - stamp).total_seconds()) < 600


def test_kafka_options():
    topic = Topic.kafka("host:9092", "sales", **{"kafka.security.protocol": "SSL"})
    assert topic.format == "kafka"
    assert topic.options == {"kafka.bootstrap.servers": "host:9092", "topic": "sales",
                             "kafka.security.protocol": "SSL"}


# --- files ------------------------------------------------------------------------


def _hot(spark, folder):
    """A third of the rows share a date, and a third are copies of one row."""
    path = folder("hot")
    n = F.col("id")
    spark.range(0, 3000, numPartitions=3).select(
        F.when(n % 3 == 0, F.lit("2020-06-01").cast("date"))
        .otherwise(F.date_add(F.lit("2020-01-01").cast("date"), (n % 300).cast("int")))
        .alias("date_recorded"),
        F.when(n % 3 == 0, F.lit(7)).otherwise(n).alias("serial_number"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_hot_date_spreads_over_parts(spark, folder):
    hot, path = _hot(spark, folder), folder("parts")
    range_split(hot, 6, "date_recorded").write.parquet(path)
    parts = spark.read.parquet(path).groupBy(
        part_number(F.col("_metadata.file_path")).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min("date_recorded").alias("low"),
        F.max("date_recorded").alias("high")).orderBy("part").collect()
    assert sum(p.n for p in parts) == 3000 and max(p.n for p in parts) < 900
    assert all(a.high <= b.low for a, b in zip(parts, parts[1:]))


def test_split_keeps_every_row(spark, folder):
    hot, path = _hot(spark, folder), folder("a")
    split_by_date(hot, 4, path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(
        map(tuple, hot.collect()))


def test_split_of_a_computed_frame(spark, folder):
    hot = _hot(spark, folder)
    computed = hot.groupBy("date_recorded").agg(F.count(F.lit(1)).alias("n"))
    assert range_split(computed, 3, "date_recorded").count() == computed.count()


def test_slices_tile_the_rows(spark, folder):
    hot = _hot(spark, folder)
    order = ["date_recorded", "serial_number"]
    expected = sorted(tuple(r) for r in hot.select(*order).collect())
    for low, high in [(0, 10), (990, 2010), (2990, 5000), (4000, 5000), (0, 3000)]:
        got = slice_rows(hot, order, low, high, parts=5).orderBy("position").collect()
        assert [tuple(r[:2]) for r in got] == expected[low:high]
        assert [r.position for r in got] == list(range(low, min(high, 3000)))


def test_read_since_is_open_then_closed(spark):
    df = spark.createDataFrame([(datetime.datetime(2020, 1, d),) for d in (1, 2, 3, 4)],
                               "created_at timestamp_ntz")
    got = read_since(df, ntz("2020-01-01 00:00:00"), ntz("2020-01-03 00:00:00"))
    assert sorted(r.created_at.day for r in got.collect()) == [2, 3]


def test_prepare(spark, folder):
    csv = folder("csv")
    spark.createDataFrame(
        [("2", "2019", "01/05/2020", "T, \"x\"", "", "1.5", "2.5", "0.5", "Condo", None, None,
          None, None, "POINT (1 2)"),
         ("1", "2019", "2020-01-04", "U", "a", "", "x", "NaN", "", None, None, None, None, "")],
        ", ".join(f"`{c}` string" for c in schemas.RAW_HEADER)).coalesce(1).write.option("escape", '"').csv(csv, header=True)
    rows = read_sales(spark, flows.prepare(spark, csv, folder("out"), parts=2)).orderBy(
        "serial_number").collect()
    assert [(r.serial_number, str(r.date_recorded), r.town, r.address, r.sale_amount,
             r.property_type, r.location) for r in rows] == [
        (1, "2020-01-04", "U", "a", None, None, None),
        (2, "2020-01-05", 'T, "x"', None, 2.5, "Condo", "POINT (1 2)")]


# --- published views ------------------------------------------------------------------


def test_refused_run_leaves_the_view(spark, folder):
    view, schema = folder("view"), schemas.BATCH_BY_TOWN
    assert read_view(spark, view, schema).collect() == []

    def counts_of(n):
        return spark.createDataFrame([("T", n)], "town string, total_customer long").withColumns(
            {"started_at": ntz(LATER), "ended_at": ntz(LATER)})

    def check(written):
        Q.require(Q.validate(written, Q.town_suite()))

    publish_view(counts_of(1), view, "r1", schema, check)
    with pytest.raises(Q.ValidationError, match="total_customer"):
        publish_view(counts_of(0), view, "r2", schema, check)
    assert released_run(spark, view) == "r1"
    publish_view(counts_of(3), view, "r3", schema, check)
    publish_view(counts_of(3), view, "r3", schema, check)  # twice is once
    assert [r.total_customer for r in read_view(spark, view, schema).collect()] == [3]


def test_batch_layer_and_panels(spark, sf_dir, folder):
    root, lake = folder("root"), sales(spark, sf_dir)
    cutoff = ntz("1998-01-01 00:00:00")
    flows.batch_layer(lake, root, "a", ntz("1996-01-01 00:00:00"), suites=SUITES)
    flows.batch_layer(lake, root, "b", cutoff, suites=SUITES)
    with pytest.raises(Q.ValidationError):
        flows.batch_layer(lake, root, "c", ntz("1999-01-01 00:00:00"))  # strict value set
    history = flows.read_totals_history(spark, root)
    assert history.count() == 2
    assert S.latest(history).first().started_at == datetime.datetime(1998, 1, 1)
    write_speed(lake.filter(F.col("created_at") >= cutoff).withColumn("created_at", cutoff), 0,
                Tables(root))
    shown = {(r.panel, r.label): r.value for r in
             flows.panels(flows.Views.open(spark, root)).collect()}
    whole = A.totals(lake).first()
    assert shown["kpi", "Total Customer"] == whole.total_customer
    assert shown["kpi", "Total Sale Amount (billion)"] == round(whole.total_sale_amount / 1e9, 2)
    assert sum(v for (p, _), v in shown.items() if p == "property_type") == lake.count()
    assert sum(1 for p, _ in shown if p == "town") == 10


def test_clustered_table_prunes_folders(spark, folder):
    path = folder("c")
    df = spark.range(10).select(
        (F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.col("id").cast("int"))).alias("created_at"), "id")
    cluster_by_date(df, path)
    table = spark.read.parquet(path)
    window = S.since(table, ntz("2020-01-03 00:00:00"), ntz("2020-01-05 00:00:00"))
    assert sorted(r.id for r in window.collect()) == [2, 3, 4]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_date" in plan


def test_clustered_table_has_few_files(spark, folder):
    path = folder("c")
    rows = spark.range(0, 4000, 1, 16).select("id", (
        ntz("2020-01-01 00:00:00") + F.make_dt_interval((F.col("id") % 50).cast("int"))).alias("created_at"))
    cluster_by_date(rows, path)
    table = spark.read.parquet(path)
    assert table.count() == 4000 and len(table.inputFiles()) == 50


@pytest.mark.parametrize("source", ["orc", "json"])
def test_views_through_a_connector(spark, folder, source):
    path, schema = folder("view"), "town string, n long"
    rows = spark.createDataFrame([("T", 1), (None, 2)], schema)
    write_view(rows, path, "append", rows.schema, format=source)
    write_view(rows, path, "append", rows.schema, format=source)
    assert counts_all(read_table(spark, path, rows.schema, format=source)) == [("T", 1)] * 2 + [(None, 2)] * 2
    write_view(rows, path, "overwrite", rows.schema, format=source)
    assert counts_all(read_table(spark, path, rows.schema, format=source)) == [("T", 1), (None, 2)]


def counts_all(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_reads_from_a_date_on_list_only_those_folders(spark, folder):
    tables = Tables(folder("t"))
    rows = spark.range(4).select(
        F.lit("T").alias("town"), F.lit("Condo").alias("property_type"),
        F.lit(1.0).alias("sale_amount"), F.lit(0.5).alias("sales_ratio"),
        (ntz("2020-01-01 00:00:00") + F.make_dt_interval(F.col("id").cast("int")))
        .alias("created_at"))
    write_speed(rows, 0, tables)
    late = read_speed(spark, tables, "town", datetime.date(2020, 1, 3))
    assert counts(late, "town") == {"T": 2}
    assert not [f for f in late.inputFiles() if "2020-01-01" in f or "2020-01-02" in f]
    assert late.schema == read_speed(spark, tables, "town").schema
    assert read_speed(spark, tables, "town", datetime.date(2021, 1, 1)).count() == 0


@pytest.mark.parametrize("at", range(2, 9))
def test_batch_run_between_any_two_writes(spark, folder, at):
    """Two streams, two micro-batches each, stored step by step; the batch layer runs after step ``at``."""
    tables, second = Tables(folder("t")), "2020-01-01 00:00:0%d"
    rows = spark.range(40).select(
        F.col("id").alias("serial_number"), F.lit("T").alias("town"), F.lit("Condo").alias("property_type"),
        F.lit(1.0).alias("sale_amount"), F.lit(0.5).alias("sales_ratio"))
    rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.LAKE
                              if f.name not in (*rows.columns, "created_at")])
    steps = []
    for number in (0, 1):
        for k, stream in enumerate(("a", "b")):
            part = rows.filter(F.col("serial_number") % 4 == 2 * number + k).withColumn(
                "created_at", ntz(second % (2 * number + k)))
            steps.append(lambda p=part, n=number, s=stream: write_batch(p, tables.lake, n, schemas.LAKE, stream=s))
            steps.append(lambda p=part, n=number, s=stream: write_speed(p, n, tables, stream=s))
    assert flows.closed_cutoff(spark, tables) is None  # no batch yet: nothing to run on
    for step in steps[:at]:
        step()
    cutoff = flows.closed_cutoff(spark, tables)
    suites = {k: Q.Suite("shape", (Q.columns_ordered(*v.names),)) for k, v in flows.BATCH_VIEWS.items()}
    flows.batch_layer(read_lake(spark, tables), tables.root, "r", cutoff, suites=suites)
    for step in steps[at:]:
        step()
    views = flows.Views.open(spark, tables.root)
    served = S.serve_by_key(views.batch["town"], views.speed["town"], "town", ntz("2021-01-01 00:00:00"))
    assert [tuple(r) for r in served.collect()] == [("T", 40)]


def test_csv_lines_that_are_no_rows_stay_on_record(spark, folder):
    csv, out, schema = folder("csv"), folder("raw"), "a long, b string, c double"
    lines = ['a,b,c', '1,x,2.5', '2,"torn', 'apart",3', '4,y,many', '5,z', '6,,7', '8,"q ""r""",9']
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(csv)
    schema = spark.createDataFrame([], schema).schema
    rows = ingest_csv(spark, csv, out, schema).collect()
    assert sorted(map(tuple, rows)) == [(1, "x", 2.5), (4, "y", None), (6, None, 7.0), (8, 'q "r"', 9.0)]
    bad = refused_lines(spark, out, schema).collect()
    assert sorted(r.line for r in bad if r.dropped) == sorted(['2,"torn', 'apart",3', '5,z'])
    assert [r.line for r in bad if not r.dropped] == ['{"a":"4","b":"y","c":"many"}']
    whole = ingest_csv(spark, csv, folder("raw"), schema, multi_line=True).collect()
    assert (2, "torn\napart", 3.0) in map(tuple, whole)


def test_an_empty_csv(spark, folder):
    csv = folder("csv")
    spark.createDataFrame([("a",)], "value string").coalesce(1).write.text(csv)
    assert ingest_csv(spark, csv, folder("raw"), spark.range(0).schema).collect() == []
