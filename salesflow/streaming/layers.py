"""The lake writer and the speed views.

The speed views are computed from what a micro-batch has put into the lake, and
carry its ``created_at``: the batch layer (``created_at < cutoff``) and the speed
layer (``created_at >= cutoff``) therefore split the same rows by the same stamp.

Streams enter a commit log (:mod:`salesflow.sources.log`): a micro-batch becomes visible by its entry, at once in
the lake, the speed views and quarantine. Readers take a :class:`Snapshot`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from salesflow import schemas
from salesflow.functions.cleaning import parse_date
from salesflow.functions.wire import decode, parse, quarantine, readable, refused
from salesflow.operators.aggregates import VIEW_KEYS, sale_cells
from salesflow.sources.log import LOWEST, Commit, CommitLog, Intervals, LogState, intervals
from salesflow.sources.tables import (
    MERGED, empty, read_appended, read_merged_too, write_batch)
from salesflow.streaming.bus import Topic, for_each_batch, stream_id, subscribe


def arrival() -> Column:
    """The start of the micro-batch in UTC.

    Spark keeps it with the offsets: a batch that runs again gets the same stamp.
    """
    return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))


@dataclass(frozen=True)
class Tables:
    """Folders of the lake and the speed views below one root."""

    root: str

    @property
    def lake(self) -> str:
        return f"{self.root}/lake"

    @property
    def speed(self) -> str:
        return f"{self.root}/speed"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"


SPEED_VIEWS: dict[str, T.StructType] = {
    "property_type": schemas.SPEED_BY_PROPERTY_TYPE,
    "town": schemas.SPEED_BY_TOWN,
    "totals": schemas.SPEED_TOTALS,
}

# How all partial views are stored: one table, a folder per view.
_PARTIALS = T.StructType([
    T.StructField("view", T.StringType(), True),
    T.StructField("label", T.StringType(), True),
    *[T.StructField(n, schemas.SPEED_TOTALS[n].dataType, True) for n in (
        "total_customer", "total_sales_ratio", "total_sale_amount", "created_at")],
])


def to_lake_rows(messages: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Messages to lake rows: decode, parse the date, stamp once."""
    return (
        decode(messages)
        .withColumn("date_recorded", parse_date(F.col("date_recorded")))
        .withColumn("created_at", arrival() if stamp is None else stamp)
    )


@contextmanager
def _adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution inside a micro-batch.

    Spark turns it off in the session of a stream, because the partitions of
    stateful operators must not change; the writes here keep no state.
    """
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def partial_views(rows: DataFrame, views: tuple[str, ...] = tuple(SPEED_VIEWS)) -> DataFrame:
    """The partial views of some rows, stacked: (view, label, measures, created_at).

    One pass over the rows makes cells per (property type, town); the views are
    grouping sets of these few cells. ``total_customer`` counts all rows of a
    label, but only complete rows in the totals.
    """
    sets = {key: [key, "created_at"] for key in VIEW_KEYS} | {"totals": ["created_at"]}
    grouped = sale_cells(rows, *VIEW_KEYS, "created_at").groupingSets(
        [sets[v] for v in views], *VIEW_KEYS, "created_at")
    view = F.lit("totals")
    for key in VIEW_KEYS:
        view = F.when(F.grouping(key) == 0, key).otherwise(view)
    return grouped.agg(
        view.alias("view"), F.sum("rows").alias("rows"),
        F.sum("complete_rows").alias("complete_rows"),
        F.sum("ratio").alias("total_sales_ratio"), F.sum("amount").alias("total_sale_amount"),
    ).select(
        "view", F.coalesce(*VIEW_KEYS, F.lit("all")).alias("label"),
        F.when(F.col("view") == "totals", F.col("complete_rows")).otherwise(F.col("rows"))
        .alias("total_customer"),
        "total_sales_ratio", "total_sale_amount", "created_at")


def write_speed(rows: DataFrame, batch_id: int, tables: Tables,
                views: tuple[str, ...] = tuple(SPEED_VIEWS), stream: str = "default") -> None:
    """Store the partial views of one micro-batch; one job, so all of them or none."""
    with _adaptive(rows.sparkSession):
        write_batch(partial_views(rows, views), tables.speed, batch_id, _PARTIALS, ("view",),
                    stream)


_STORED = T.StructType(_PARTIALS.fields[1:])  # without the folder of the view
LAKE_PART, SPEED_PART, QUARANTINE_PART = "lake", "speed", "quarantine"


def _as_view(partials: DataFrame, view: str) -> DataFrame:
    schema = schemas.partitioned(SPEED_VIEWS[view])
    return partials.withColumnRenamed("label", view).select(*schema.names)


def folders_of(runs: Intervals, units: dict[str, int]) -> Column:
    """The condition on the partition columns that holds for these micro-batches and merged units."""
    found = F.lit(False)
    for stream, own in runs.items():
        number = F.lit(False)
        for first, last in own:
            number = number | F.col("batch_id").between(first, last)
        found = found | ((F.col("stream") == stream) & number)
    if units:
        of_date = F.create_map(*[F.lit(v) for pair in units.items() for v in pair])
        merged = of_date[F.col("created_date").cast("string")] == F.col("batch_id")
        found = found | ((F.col("stream") == MERGED) & F.coalesce(merged, F.lit(False)))
    return found


@dataclass(frozen=True)
class Snapshot:
    """The micro-batches that are stored at one moment: the same ones in all tables, and the cutoff that fits them."""

    spark: SparkSession
    tables: Tables
    log: LogState

    @classmethod
    def take(cls, spark: SparkSession, tables: Tables) -> Snapshot:
        return cls(spark, tables, CommitLog(spark, tables.root).state())

    def cutoff(self) -> datetime | None:
        """All rows of the lake with an earlier stamp are in this snapshot, and no more will come."""
        return self.log.frontier()

    def _read(self, path: str, part: str, schema: T.StructType, since: date | None) -> DataFrame:
        own: dict[str, list[int]] = {}
        for c in self.log.live():
            if part in c.parts and c.newest:
                own.setdefault(c.stream, []).append(c.batch_id)
        if not own and not self.log.manifest.units:
            return empty(self.spark, schemas.partitioned(schema))
        try:
            return read_merged_too(
                self.spark, path, schema, folders_of(intervals(own), self.log.manifest.units), since)
        except AnalysisException as error:  # none of the batches had a row for this table
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty(self.spark, schemas.partitioned(schema))

    def lake(self, since: date | None = None) -> DataFrame:
        return self._read(self.tables.lake, LAKE_PART, schemas.LAKE, since)

    def partials(self, view: str, since: date | None = None) -> DataFrame:
        return self._read(f"{self.tables.speed}/view={view}", SPEED_PART, _STORED, since)

    def speed(self, view: str, since: date | None = None) -> DataFrame:
        return _as_view(self.partials(view, since), view)

    def quarantine(self, since: date | None = None) -> DataFrame:
        return self._read(self.tables.quarantine, QUARANTINE_PART, schemas.QUARANTINE, since)


def read_speed(spark: SparkSession, tables: Tables, view: str,
               since: date | None = None) -> DataFrame:
    """A speed view with its own columns, plus ``created_date``, ``stream`` and ``batch_id``."""
    if CommitLog(spark, tables.root).exists():
        return Snapshot.take(spark, tables).speed(view, since)
    return _as_view(read_appended(spark, f"{tables.speed}/view={view}", _STORED, since), view)


def read_lake(spark: SparkSession, tables: Tables, since: date | None = None) -> DataFrame:
    """The lake: what the commit log has, or all folders where no stream has entered one."""
    if CommitLog(spark, tables.root).exists():
        return Snapshot.take(spark, tables).lake(since)
    return read_appended(spark, tables.lake, schemas.LAKE, since)


def read_quarantine(spark: SparkSession, tables: Tables, since: date | None = None) -> DataFrame:
    """The messages that could not be read in full: value, dropped, created_at."""
    return Snapshot.take(spark, tables).quarantine(since)


def _lake_batch(spark: SparkSession, tables: Tables, batch_id: int, stream: str) -> DataFrame:
    """The lake rows of one micro-batch; lists only that batch's folders."""
    schema = schemas.partitioned(schemas.LAKE)
    try:
        return (
            spark.read.schema(schema).option("basePath", tables.lake)
            .parquet(f"{tables.lake}/created_date=*/stream={stream}/batch_id={batch_id}")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)  # no readable message in this batch


# --- micro-batches ---------------------------------------------------------------------

ARRIVED = "created_at"
# Of a micro-batch larger than the memory for it, the rest is parsed again instead of put on disk.
_MEMORY = StorageLevel(False, True, False, True)


@dataclass
class MicroBatch:
    """One micro-batch of messages on its way into the tables.

    ``steps`` store its parts one after the other, in folders of its own; none is visible before the
    last step has written the entry in the log. A repeated micro-batch that has its entry is left alone.
    """

    messages: DataFrame  # value, created_at
    batch_id: int
    tables: Tables
    stream: str
    registration: str
    stamp: Column | None = None
    parts: tuple[str, ...] = (LAKE_PART, QUARANTINE_PART, SPEED_PART)
    views: tuple[str, ...] = tuple(SPEED_VIEWS)
    seen: dict[str, dict] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.spark = self.messages.sparkSession
        self.log = CommitLog(self.spark, self.tables.root)
        self.parsed = parse(self.messages)

    def rows(self) -> DataFrame:
        """Lake rows: the date parsed, one stamp."""
        return readable(self.parsed).withColumns({
            "date_recorded": parse_date(F.col("date_recorded")),
            ARRIVED: F.col(ARRIVED) if self.stamp is None else self.stamp})

    def _counted(self, name: str, df: DataFrame, *more: Column) -> DataFrame:
        """Count what an action writes while it writes it."""
        observation = Observation(f"{name}-{self.stream}-{self.batch_id}")
        self.seen[name] = {"observation": observation}
        return df.observe(observation, F.count(F.lit(1)).alias("n"), F.min(ARRIVED).alias("oldest"),
                          F.max(ARRIVED).alias("newest"), *more)

    def store_lake(self) -> None:
        write_batch(self._counted(LAKE_PART, self.rows()), self.tables.lake, self.batch_id, schemas.LAKE,
                    stream=self.stream)

    def store_quarantine(self) -> None:
        found = refused(self.parsed)
        if self.stamp is not None:
            found = found.withColumn(ARRIVED, self.stamp)
        write_batch(self._counted(QUARANTINE_PART, found, F.count_if("dropped").alias("dropped")),
                    self.tables.quarantine, self.batch_id, schemas.QUARANTINE, stream=self.stream)

    def store_speed(self) -> None:
        if LAKE_PART in self.parts:  # four columns of what has just been stored
            rows = _lake_batch(self.spark, self.tables, self.batch_id, self.stream)
        else:
            rows = self._counted(SPEED_PART, self.rows())
        write_speed(rows, self.batch_id, self.tables, self.views, self.stream)

    def enter(self) -> None:
        found = {name: kept["observation"].get for name, kept in self.seen.items()}
        stored = found.get(LAKE_PART) or found.get(SPEED_PART) or {}
        stamps = [f[k] for f in found.values() for k in ("oldest", "newest") if f.get(k) is not None]
        self.log.commit(Commit(
            self.stream, self.batch_id, self.registration, self.parts, stored.get("n", 0),
            found.get(QUARANTINE_PART, {}).get("dropped", 0),
            min(stamps, default=None), max(stamps, default=None)))

    def steps(self) -> list[Callable[[], None]]:
        store = {LAKE_PART: self.store_lake, QUARANTINE_PART: self.store_quarantine, SPEED_PART: self.store_speed}
        return [*(store[p] for p in (LAKE_PART, QUARANTINE_PART, SPEED_PART) if p in self.parts), self.enter]

    def run(self) -> None:
        if self.log.has(self.stream, self.batch_id):
            return
        if self._readers() < 2:
            self._run_steps()
            return
        self.parsed = self.parsed.persist(_MEMORY)  # parsed once for the lake and for quarantine
        try:
            self._run_steps()
        finally:
            self.parsed.unpersist()

    def _readers(self) -> int:
        """How many steps read the messages: the partial views read what is in the lake, if there is one."""
        return sum(p in self.parts for p in (LAKE_PART, QUARANTINE_PART)) + (LAKE_PART not in self.parts)

    def _run_steps(self) -> None:
        for step in self.steps():
            step()


def _run(spark: SparkSession, topic: Topic, tables: Tables, checkpoint: str, stamp: Column | None,
         every: str | None, per_trigger: int | None, **how: tuple[str, ...]) -> StreamingQuery:
    """A stream into the tables, entered in the log before it starts."""
    messages = subscribe(spark, topic, per_trigger=per_trigger).select("value", arrival().alias(ARRIVED))
    # stamps of its own choice may lie anywhere
    since = LOWEST if stamp is not None else datetime.now(timezone.utc).replace(tzinfo=None)
    registration = CommitLog(spark, tables.root).open_stream(checkpoint, since)

    def write(df: DataFrame, batch_id: int) -> None:
        own = df.sparkSession  # of the micro-batch: the caller's settings stay as they are
        MicroBatch(df, batch_id, tables, stream_id(own, checkpoint), registration, stamp, **how).run()

    return for_each_batch(messages, write, checkpoint, every)


def run_lake(spark: SparkSession, topic: Topic, tables: Tables, checkpoint: str,
             stamp: Column | None = None, every: str | None = None,
             per_trigger: int | None = None) -> StreamingQuery:
    """Topic to lake."""
    return _run(spark, topic, tables, checkpoint, stamp, every, per_trigger, parts=(LAKE_PART,))


def run_speed_views(spark: SparkSession, topic: Topic, tables: Tables, checkpoint: str,
                    stamp: Column | None = None, every: str | None = None,
                    per_trigger: int | None = None,
                    views: tuple[str, ...] = tuple(SPEED_VIEWS)) -> StreamingQuery:
    """Topic to speed views, without a lake.

    Messages are read with the whole wire schema, so that the same messages
    count as readable here and in the lake.
    """
    return _run(spark, topic, tables, checkpoint, stamp, every, per_trigger, parts=(SPEED_PART,), views=views)


def run_ingest(spark: SparkSession, topic: Topic, tables: Tables, checkpoint: str,
               stamp: Column | None = None, every: str | None = None,
               per_trigger: int | None = None) -> StreamingQuery:
    """Topic to lake, quarantine and speed views with one stamp per micro-batch.

    Messages are parsed once; the partial views read four columns of the files just written.
    """
    return _run(spark, topic, tables, checkpoint, stamp, every, per_trigger)


def run_quarantine(spark: SparkSession, topic: Topic, path: str, checkpoint: str,
                   every: str | None = None) -> StreamingQuery:
    """Topic to a folder of messages that could not be read in full."""
    writer = (
        quarantine(subscribe(spark, topic)).writeStream.format("parquet")
        .outputMode("append").option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)
