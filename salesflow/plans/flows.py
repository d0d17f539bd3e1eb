"""End-to-end flows. Only here do defaults read the clock."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow import schemas
from salesflow.functions.cleaning import (
    below, blank_to_null, cast_sales, ntz, scaled, snake_case, stamp)
from salesflow.operators import features, quality, regression
from salesflow.operators.aggregates import VIEW_KEYS, cells_by, cells_totals, sale_cells
from salesflow.operators.serving import serve_by_key, serve_totals, top_k
from salesflow.session import stage
from salesflow.sources.files import ingest_csv, part_count, split_by_date
from salesflow.sources.log import CommitLog, latest
from salesflow.sources.log import publish as publish_version
from salesflow.sources.tables import (
    created_before, publish_view, read_since, read_table, read_view, write_view)
from salesflow.streaming.bus import Topic, publish, stream_sales
from salesflow.streaming.compaction import compact, sweep
from salesflow.streaming.layers import SPEED_VIEWS, Snapshot, Tables, read_lake, read_speed, run_ingest


def now() -> Column:
    """The present moment in UTC, fixed when called."""
    return ntz(datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f"))


def prepare(spark: SparkSession, csv_path: str, out: str, parts: int | None = None) -> str:
    """Raw CSV to cleaned part files in date order. Returns their folder."""
    raw = ingest_csv(spark, csv_path, f"{out}/raw")
    clean = blank_to_null(cast_sales(snake_case(raw), schemas.SALE))
    split_by_date(clean, parts or part_count(raw.count()), f"{out}/parts")
    return f"{out}/parts"


def closed_cutoff(spark: SparkSession, tables: Tables) -> Column | None:
    """A cutoff that splits the rows exactly while streams run; None before the first batch.

    The streams' log has it: every open stream's frontier is just above its last stored micro-batch, or the
    moment it was opened, and the cutoff is the lowest of them; retired streams hold nothing up. Take the lake
    from the same :class:`Snapshot`, or after the cutoff (:func:`run_batch` does).

    Tables that were written without a log count by the stored partials of their streams.
    """
    if CommitLog(spark, tables.root).exists():
        frontier = Snapshot.take(spark, tables).cutoff()
        return _literal(frontier) if frontier else None
    try:
        newest = read_speed(spark, tables, "totals").groupBy("stream").agg(F.max("created_at").alias("at"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = newest.agg(F.min("at").alias("at")).first().at
    return _literal(last + timedelta(microseconds=1)) if last else None


def _literal(moment: datetime) -> Column:
    return ntz(moment.isoformat(sep=" ", timespec="microseconds"))


def retire_stream(spark: SparkSession, tables: Tables, checkpoint: str) -> None:
    """A stream will not run again from its checkpoint: it no longer holds the cutoff back.

    A micro-batch that it had begun and not stored is given up; its messages are still on the topic, for
    a stream with another checkpoint.
    """
    CommitLog(spark, tables.root).close_stream(checkpoint, force=True)


# --- batch layer -----------------------------------------------------------------

BATCH_VIEWS: dict[str, T.StructType] = {
    "property_type": schemas.BATCH_BY_PROPERTY_TYPE,
    "town": schemas.BATCH_BY_TOWN,
    "totals": schemas.BATCH_TOTALS,
}


def batch_view_path(root: str, view: str) -> str:
    return f"{root}/batch/{view}"


def batch_layer(lake: DataFrame, root: str, run_id: str, cutoff: Column,
                ended_at: Column | None = None,
                suites: dict[str, quality.Suite] | None = None) -> dict[str, DataFrame]:
    """Recompute, check and release the three batch views of the sales before ``cutoff``.

    The lake is read once: all views are sums over its cells. ``started_at`` is the
    cutoff, so serving adds exactly the partials that are missing here. A view that
    fails its suite raises and stays as it was; the totals are also kept per run.
    """
    suites = suites or {
        "property_type": quality.property_type_suite(),
        "town": quality.town_suite(),
        "totals": quality.totals_suite(),
    }
    ended_at = now() if ended_at is None else ended_at
    cells = stage(sale_cells(created_before(lake, cutoff), *VIEW_KEYS), "batch-cells")
    done = {}
    for view, schema in BATCH_VIEWS.items():
        result = cells_totals(cells) if view == "totals" else cells_by(cells, view)
        result = stamp(result, started_at=cutoff, ended_at=ended_at)
        done[view] = publish_view(
            result, batch_view_path(root, view), run_id, schema,
            check=lambda written, s=suites[view]: quality.require(quality.validate(written, s)))
    # by run: a run that is tried again replaces its own row
    write_view(done["totals"], f"{root}/batch/totals_history/run_id={run_id}", "overwrite",
               schemas.BATCH_TOTALS)
    return done


def run_batch(spark: SparkSession, tables: Tables, run_id: str, ended_at: Column | None = None,
              suites: dict[str, quality.Suite] | None = None) -> dict[str, DataFrame]:
    """The batch layer over one snapshot of the lake, up to the cutoff that fits it; {} before the first stream."""
    snapshot = Snapshot.take(spark, tables)
    cutoff = snapshot.cutoff()
    if cutoff is None:
        return {}
    return batch_layer(snapshot.lake(), tables.root, run_id, _literal(cutoff), ended_at, suites)


def read_batch(spark: SparkSession, root: str, view: str) -> DataFrame:
    """The released run of a batch view."""
    return read_view(spark, batch_view_path(root, view), BATCH_VIEWS[view])


def read_totals_history(spark: SparkSession, root: str) -> DataFrame:
    """The totals of every run."""
    history = read_table(spark, f"{root}/batch/totals_history", schemas.BATCH_TOTALS)
    return history.select(*schemas.BATCH_TOTALS.names)


# --- speed layer -----------------------------------------------------------------


def speed_layer(spark: SparkSession, feed: str, root: str, topic: Topic | None = None,
                every: str | None = None, files_per_trigger: int | None = None,
                stamp_with: Column | None = None,
                messages_per_trigger: int | None = None) -> Tables:
    """Watched folder to topic, topic to lake, speed views and (what is unreadable) quarantine, in one stream.

    ``files_per_trigger`` paces the feed; ``messages_per_trigger`` bounds a micro-batch of
    the topic in its own unit (offsets of a broker, files of a folder). With
    ``every=None`` everything present is processed, then the queries end; otherwise
    they run until stopped (``spark.streams.active``); one that will not be started again is retired
    (:func:`retire_stream`).
    """
    topic = topic or Topic.folder(f"{root}/topic")
    tables = Tables(root)
    feeding = publish(
        stream_sales(spark, feed, files_per_trigger=files_per_trigger), topic,
        f"{root}/checkpoints/publish", every)
    if every is None:
        feeding.awaitTermination()
    checkpoint = f"{root}/checkpoints/ingest"
    ingest = run_ingest(spark, topic, tables, checkpoint, stamp_with, every, messages_per_trigger)
    if every is None:
        ingest.awaitTermination()
        CommitLog(spark, root).close_stream(checkpoint)  # until it is started again
    return tables


# --- serving -----------------------------------------------------------------------


@dataclass(frozen=True)
class Views:
    """The batch and speed frames that serving merges."""

    batch: dict[str, DataFrame]
    speed: dict[str, DataFrame]

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> Views:
        """The released batch views, and the partials from the day of each cutoff on."""
        batch = {v: read_batch(spark, root, v) for v in BATCH_VIEWS}
        first = {
            v: df.agg(F.max(F.col("started_at").cast("date")).alias("d")).first().d
            for v, df in batch.items()}
        tables = Tables(root)
        if CommitLog(spark, root).exists():  # the same micro-batches in all views
            snapshot = Snapshot.take(spark, tables)
            return cls(batch, {v: snapshot.speed(v, first[v]) for v in SPEED_VIEWS})
        return cls(batch, {v: read_speed(spark, tables, v, first[v]) for v in SPEED_VIEWS})


PANEL = "panel string, label string, value double"


def panels(views: Views, at: Column | None = None, top: int = 10) -> DataFrame:
    """All figures of the dashboard: (panel, label, value).

    Three key figures, the counts per property type, the towns with most sales.
    """
    at = now() if at is None else at
    total = serve_totals(views.batch["totals"], views.speed["totals"], at)

    def figure(label: str, value: Column) -> Column:
        return F.struct(F.lit("kpi").alias("panel"), F.lit(label).alias("label"),
                        value.cast("double").alias("value"))

    kpis = total.select(F.inline(F.array(
        figure("Total Sale Amount (billion)", scaled(F.col("total_sale_amount"), 1e9, 2)),
        figure("Total Customer", F.col("total_customer")),
        figure("Avg Sale Ratio", scaled(F.col("average_sale_ratio"), 1.0, 2)))))

    def chart(view: str, counts: DataFrame) -> DataFrame:
        return counts.select(F.lit(view).alias("panel"), F.col(view).alias("label"),
                             F.col("total_customer").cast("double").alias("value"))

    kinds = serve_by_key(
        views.batch["property_type"], views.speed["property_type"], "property_type", at)
    towns = serve_by_key(views.batch["town"], views.speed["town"], "town", at)
    return (
        kpis.unionByName(chart("property_type", kinds))
        .unionByName(chart("town", top_k(towns, "total_customer", "town", top)))
    )


# --- prediction --------------------------------------------------------------------


def model_frames(sales: DataFrame, seed: int = 0,
                 fit_on: str = "train") -> tuple[DataFrame, DataFrame]:
    """Training and test feature frames, written once because every fit reads them.

    ``fit_on="all"`` learns the feature statistics from both parts.
    """
    return _learnt_frames(sales, seed, fit_on)[:2]


def _learnt_frames(sales: DataFrame, seed: int = 0, fit_on: str = "train",
                   ) -> tuple[DataFrame, DataFrame, features.FeatureStats]:
    usable = below(sales, "sale_amount", features.AMOUNT_LIMIT)
    train, test = features.train_test_split(usable, "serial_number", seed=seed)
    stats = features.fit_features(usable if fit_on == "all" else train)
    both = stage(
        features.feature_frame(usable, stats, "serial_number")
        .withColumn("in_test", features.in_test("serial_number", seed=seed)), "features")
    return both.filter(~F.col("in_test")), both.filter(F.col("in_test")), stats


def retrain(lake: DataFrame, last: Column, until: Column,
            alpha: float = regression.FINAL_ALPHA, path: str | None = None) -> DataFrame:
    """Fit the final model on the sales of a window and score it on the held-out part.

    Returns (model, train_rows, test_rows, explained_variance, mape); with ``path`` the model and all that
    its features have learnt become the next version there, both or none (see :func:`score`).
    """
    spark = lake.sparkSession
    begun_at = latest(spark, f"{path}/versions")[0] if path else 0
    train, test, stats = _learnt_frames(read_since(lake, last, until))
    model = regression.fit(train, features.FEATURES, features.LABEL, regression.lasso(alpha))
    if path:
        release_model(spark, path, model, stats, begun_at)
    scored = regression.predict(model, test, features.FEATURES)
    y, p = F.col(features.LABEL), F.col(regression.PREDICTION)
    return scored.agg(
        F.lit(f"Lasso({alpha:g})").alias("model"),
        F.lit(train.count()).alias("train_rows"),
        F.count(F.lit(1)).alias("test_rows"),
        regression.explained_variance(y, p).alias("explained_variance"),
        regression.mape(y, p).alias("mape"))


def release_model(spark: SparkSession, path: str, model: LinearRegressionModel, stats: features.FeatureStats,
                  after: int) -> int:
    """Write a model and its features to a folder of their own, then make that the version after ``after``."""
    attempt = uuid.uuid4().hex
    regression.save(model, f"{path}/runs/{attempt}")
    features.save_features(spark, stats, f"{path}/runs/{attempt}/features")
    return publish_version(spark, f"{path}/versions", {"run": attempt}, after)


def model_folder(spark: SparkSession, path: str) -> str:
    """Where the newest version of a model lies; ``path`` itself if it holds a model without versions."""
    version = latest(spark, f"{path}/versions")[1]
    return f"{path}/runs/{version['run']}" if version else path


def score(path: str, sales: DataFrame, stats: features.FeatureStats | None = None) -> DataFrame:
    """Apply the newest model that :func:`retrain` has released to sales.

    Model and features are of one version; ``stats`` replaces the features' part.
    """
    folder = model_folder(sales.sparkSession, path)
    stats = stats or features.load_features(sales.sparkSession, f"{folder}/features")
    frame = features.feature_frame(sales, stats, "serial_number")
    return regression.predict(regression.load(folder), frame, features.FEATURES)


__all__ = [
    "prepare", "closed_cutoff", "retire_stream", "batch_layer", "run_batch", "read_batch", "read_totals_history",
    "speed_layer", "Views", "panels", "model_frames", "retrain", "release_model", "model_folder", "score",
    "read_lake", "BATCH_VIEWS", "Snapshot", "compact", "sweep",
]
