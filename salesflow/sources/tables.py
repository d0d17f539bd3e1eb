"""Tables: full and incremental reads, replaced and appended views, published runs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow import schemas
from salesflow.session import shuffles_removed
from salesflow.sources.log import latest, publish


def read_table(spark: SparkSession, name: str, schema: T.StructType | None = None,
               **options: str) -> DataFrame:
    """A whole table.

    ``name`` is a folder of parquet files, or a catalogue table when it has no
    ``/``; with ``format=`` any other connector on the classpath is used.
    """
    source = options.pop("format", None)
    if source and "/" in name:
        reader = spark.read.format(source).options(**options)
        return (reader.schema(schema) if schema else reader).load(name)
    if source:
        return spark.read.format(source).options(**options).option("dbtable", name).load()
    if "/" not in name:
        return spark.read.table(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.options(**options).parquet(name)


def write_view(df: DataFrame, name: str, mode: str, schema: T.StructType | None = None,
               partition_by: tuple[str, ...] = (), **options: str) -> None:
    """Replace (``overwrite``) or extend (``append``) a table, checked against its schema.

    ``name`` as in :func:`read_table`; with ``format=`` any connector on the classpath takes
    the rows, and a ``name`` with a ``/`` is its folder.
    """
    out = schemas.conform(df, schema) if schema else df
    source = options.pop("format", None)
    writer = out.write.mode(mode).options(**options).partitionBy(*partition_by)
    if source and "/" in name:
        writer.format(source).save(name)
    elif source:
        writer.format(source).option("dbtable", name).save()
    elif "/" in name:
        writer.parquet(name)
    else:
        writer.saveAsTable(name)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def create_empty(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """An empty table, unless there is one."""
    empty(spark, schema).write.mode("ignore").parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int, schema: T.StructType,
                first_by: tuple[str, ...] = (), stream: str = "default") -> None:
    """Append one micro-batch to a table clustered by the date of ``created_at``.

    The rows land in ``created_date=../stream=../batch_id=..`` (below the folders of
    ``first_by``). Writing the same batch of the same stream again replaces exactly
    those folders, so a retry neither loses nor repeats. Batch numbers start anew with
    every checkpoint: ``stream`` keeps the streams of a table apart.
    """
    (
        schemas.conform(df, schema)
        .withColumn("created_date", F.col("created_at").cast("date"))
        .withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("long")})
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy(*first_by, "created_date", "stream", "batch_id").parquet(path)
    )


def read_appended(spark: SparkSession, path: str, schema: T.StructType,
                  since: date | None = None) -> DataFrame:
    """A table written by :func:`write_batch`, with its partition columns.

    With ``since`` the folders of earlier dates are not even listed, which counts
    when years of micro-batches lie behind.
    """
    reader = spark.read.schema(schemas.partitioned(schema))
    if since is None:
        return reader.parquet(path)
    folders = [f for f in date_folders(spark, path) if f >= f"{path}/created_date={since}"]
    if not folders:
        return empty(spark, schemas.partitioned(schema))
    return reader.option("basePath", path).parquet(*folders)


MERGED = "_merged"  # the folder, in place of a stream's, of rows of several micro-batches
_ORIGIN = [T.StructField("from_stream", T.StringType(), True), T.StructField("from_batch", T.LongType(), True)]


def write_merged(df: DataFrame, path: str, schema: T.StructType, unit: int,
                 first_by: tuple[str, ...] = ()) -> None:
    """Rows of :func:`read_appended` as one unit: few files per date, each row with its stream and batch."""
    with shuffles_removed(df.sparkSession):
        (
            df.select(*schema.names, F.col("stream").alias("from_stream"), F.col("batch_id").alias("from_batch"),
                      "created_date")
            .withColumns({"stream": F.lit(MERGED), "batch_id": F.lit(unit).cast("long")})
            .hint("rebalance", *[F.col(c) for c in (*first_by, "created_date")])
            .write.mode("append").option("compression", "zstd")
            .partitionBy(*first_by, "created_date", "stream", "batch_id").parquet(path)
        )


def read_merged_too(spark: SparkSession, path: str, schema: T.StructType, live: Column,
                    since: date | None = None) -> DataFrame:
    """The rows whose folder satisfies ``live``, a condition on the partition columns, so that others aren't read.

    Merged rows come with the stream and batch they were stored by.
    """
    rows = read_appended(spark, path, T.StructType(schema.fields + _ORIGIN), since).filter(live)
    return rows.select(*schema.names, "created_date",
                       F.coalesce("from_stream", "stream").alias("stream"),
                       F.coalesce("from_batch", "batch_id").alias("batch_id"))


def date_folders(spark: SparkSession, path: str) -> list[str]:
    """The date folders of a table: one name per day."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/created_date=*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f"{path}/{s.getPath().getName()}" for s in files.globStatus(pattern) or [])


def cluster_by_date(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write a table laid out by the date of ``created_at``, so windows prune folders.

    Rows are shuffled by date, so a date has few files; adaptive execution joins small
    dates in one task and splits a hot one among several.
    """
    (
        df.withColumn("created_date", F.col("created_at").cast("date"))
        .hint("rebalance", F.col("created_date"))
        .write.mode(mode).partitionBy("created_date").parquet(path)
    )


def created_before(df: DataFrame, end: Column) -> DataFrame:
    """Rows with ``created_at < end``; also prunes by date where the table has it."""
    if "created_date" in df.columns:
        df = df.filter(F.col("created_date") <= end.cast("date"))
    return df.filter(F.col("created_at") < end)


def read_since(df: DataFrame, last: Column, now: Column) -> DataFrame:
    """Rows with ``last < created_at <= now``; also prunes by date where the table has it."""
    if "created_date" in df.columns:
        df = df.filter(F.col("created_date").between(last.cast("date"), now.cast("date")))
    return df.filter((F.col("created_at") > last) & (F.col("created_at") <= now))


# --- published views -------------------------------------------------------
#
# A view is a folder of runs and the numbered versions of what was released. A run that
# fails its checks stays unreleased; readers see the last released one throughout.


def run_path(view: str, run_id: str, attempt: str) -> str:
    return f"{view}/runs/{run_id}/{attempt}"


def release(spark: SparkSession, view: str, run_id: str, attempt: str, after: int) -> int:
    """Make a written run the version that follows ``after``.

    The number decides, not a clock: of two writers that began at the same version one wins, the
    other gets :class:`salesflow.sources.log.Conflict` and has changed nothing.
    """
    return publish(spark, f"{view}/versions", {"run_id": run_id, "attempt": attempt}, after)


def released_version(spark: SparkSession, view: str) -> tuple[int, dict | None]:
    """(number, run) of the newest version; (0, None) before the first."""
    return latest(spark, f"{view}/versions")


def released_run(spark: SparkSession, view: str) -> str | None:
    """Id of the run released last; None before the first."""
    run = released_version(spark, view)[1]
    return run["run_id"] if run else None


def read_view(spark: SparkSession, view: str, schema: T.StructType) -> DataFrame:
    """The released run of a view; no rows before the first."""
    run = released_version(spark, view)[1]
    if run is None:
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(run_path(view, run["run_id"], run["attempt"]))


def publish_view(df: DataFrame, view: str, run_id: str, schema: T.StructType,
                 check: Callable[[DataFrame], object] | None = None) -> DataFrame:
    """Write a run, check what was written, then release it.

    ``check`` raises to refuse the run; the previous one then stays visible. Every
    attempt has a folder of its own: a run that is tried again under the same id
    never touches what was released, nor the files of running readers. A run is released only
    over the version that was the newest when it began.
    """
    spark, attempt = df.sparkSession, uuid.uuid4().hex
    begun_at, _ = released_version(spark, view)
    path = run_path(view, run_id, attempt)
    schemas.conform(df, schema).write.parquet(path)
    written = spark.read.schema(schema).parquet(path)
    if check:
        check(written)
    release(spark, view, run_id, attempt, begun_at)
    return written
