"""Raw files and the prepared sale files."""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow import schemas
from salesflow.session import rounds_of, shuffles_removed, stage, work_dir
from salesflow.sources.log import remove
from salesflow.sources.records import csv_records


def read_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.RAW,
             multi_line: bool = False) -> DataFrame:
    """A headed CSV with a declared schema. Empty fields are null, ``""`` is a quote.

    One line is one row, so that a large file is split among tasks; ``multi_line`` allows
    line breaks within quotes, at the price of one task per file (:func:`ingest_csv` has
    ``records`` for both).
    """
    return _csv(spark, multi_line).schema(schema).csv(path)


def _csv(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)


def ingest_csv(spark: SparkSession, csv_path: str, parquet_path: str,
               schema: T.StructType = schemas.RAW, multi_line: bool = False,
               records: bool = False) -> DataFrame:
    """Convert a headed CSV to parquet and return the rows that were read.

    A line with too few or too many fields (as a line break within quotes makes it) is no
    row; a field of the wrong type is null in that field only. Both stay on record, see
    :func:`refused_lines`. ``records`` allows line breaks within quotes in files that are
    split among tasks, see :mod:`salesflow.sources.records`.
    """
    fields = schemas.texts(schema).add(_BROKEN, T.StringType())
    if records:
        lines = _records(spark, csv_path, fields)
    else:
        lines = _csv(spark, multi_line).schema(fields).option("columnNameOfCorruptRecord", _BROKEN).csv(csv_path)
    cells = {n: F.col(f"`{n}`").try_cast(schema[n].dataType) for n in schema.names}
    wrong = F.lit(False)
    for name, cell in cells.items():
        wrong = wrong | (F.col(f"`{name}`").isNotNull() & cell.isNull())
    line = F.when(F.col(_BROKEN).isNotNull(), F.col(_BROKEN)).when(
        wrong, F.to_json(F.struct(*[F.col(f"`{n}`") for n in schema.names])))
    lines.select(
        *[cell.alias(name) for name, cell in cells.items()], line.alias(_LINE),
        F.col(_BROKEN).isNotNull().alias(_DROPPED),
    ).write.mode("overwrite").option("compression", "zstd").partitionBy(_DROPPED).parquet(parquet_path)
    return _ingested(spark, parquet_path, schema).filter(~F.col(_DROPPED)).select(
        *[f"`{n}`" for n in schema.names])


_BROKEN, _LINE, _DROPPED = "_broken", "_line", "_dropped"


def _records(spark: SparkSession, path: str, fields: T.StructType) -> DataFrame:
    """The records of a headed CSV as texts; what is no record has its line in the last column."""
    kind = ", ".join(f"`{f.name}` string" for f in fields)
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": _BROKEN}
    row = csv_records(spark, path).select(
        F.from_csv("record", kind, options).alias("row"), "record", "torn")
    return row.select(
        *[F.when(~F.col("torn"), F.col("row").getField(f.name)).alias(f.name) for f in fields.fields[:-1]],
        F.when(F.col("torn"), F.col("record")).otherwise(F.col("row").getField(_BROKEN)).alias(_BROKEN))


def _ingested(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    kept = [*schema, T.StructField(_LINE, T.StringType()), T.StructField(_DROPPED, T.BooleanType())]
    return spark.read.schema(T.StructType(kept)).parquet(path)


def refused_lines(spark: SparkSession, parquet_path: str,
                  schema: T.StructType = schemas.RAW) -> DataFrame:
    """(line, dropped) of what :func:`ingest_csv` could not read in full.

    ``line`` is the text of a line that is no row, or the fields of a row (JSON) of which
    some are stored as null.
    """
    return _ingested(spark, parquet_path, schema).filter(F.col(_LINE).isNotNull()).select(
        F.col(_LINE).alias("line"), F.col(_DROPPED).alias("dropped"))


def read_sales(spark: SparkSession, path: str, schema: T.StructType = schemas.SALE) -> DataFrame:
    """Prepared sale files, without schema inference."""
    return spark.read.schema(schema).parquet(path)


def scan_position() -> Column:
    """A number per stored row that is the same whenever the row is read again."""
    return F.xxhash64("_metadata.file_path", "_metadata.row_index")


def with_position(df: DataFrame, name: str = "_tie") -> DataFrame:
    """``df`` with a last sort key that tells equal rows apart.

    With it a hot value, or many copies of one row, spreads over several range
    partitions, and a task that runs again puts every row where it was before.
    A frame that is not a plain read of parquet files is written first.
    """
    return _addressed(df).withColumn(name, scan_position())


def _addressed(df: DataFrame) -> DataFrame:
    """``df``, if its rows have places in files, or else a stored copy."""
    try:
        df.select(scan_position())
    except AnalysisException:
        return stage(df, "positions")
    return df


def range_split(df: DataFrame, n: int | None, *by: str, number: str | None = None) -> DataFrame:
    """``n`` parts (default: the shuffle partitions) with consecutive ranges of ``by``.

    ``number`` names a column for the number of the part.
    """
    keyed = with_position(df)
    keys = (*by, "_tie")
    ranged = keyed.repartitionByRange(n, *keys) if n else keyed.repartitionByRange(*keys)
    if number:
        ranged = ranged.withColumn(number, F.spark_partition_id())
        keys = (number, *keys)
    return ranged.sortWithinPartitions(*keys).drop("_tie")


def split_by_date(df: DataFrame, n: int, path: str, date: str = "date_recorded") -> None:
    """Write ``n`` part files with consecutive date ranges, in part order.

    A large table is shuffled and sorted in rounds (:func:`salesflow.session.rounds_of`): each takes the rows of
    consecutive parts, at least two, so that what it shuffles and spills is a fraction of the table.
    """
    spark, df = df.sparkSession, _addressed(df)
    rounds = min(rounds_of(df), max(1, n // 2))
    ends = [n * (i + 1) // rounds for i in range(rounds)]  # of each round, in parts
    bounds = _bounds(df, date, [end / n for end in ends[:-1]])
    with shuffles_removed(spark):
        if not bounds:
            range_split(df, n, date).write.mode("overwrite").option("compression", "zstd").parquet(path)
            return
        folder, _, name = path.rstrip("/").rpartition("/")
        written = f"{folder}/_{name}-{uuid.uuid4().hex[:12]}"
        for i, (first, end) in enumerate(zip([0, *ends], ends)):
            mine = df
            if i:
                mine = mine.filter(~_before(date, bounds[i - 1]))
            if i < len(bounds):
                mine = mine.filter(_before(date, bounds[i]))
            range_split(mine, end - first, date).write.option("compression", "zstd").parquet(f"{written}/{i}")
    remove(spark, path)
    for i, first in enumerate([0, *ends[:-1]]):
        _move_parts(spark, f"{written}/{i}", path, first)
    remove(spark, written)


def _bounds(df: DataFrame, date: str, shares: list[float], sample: int = 20_000) -> list[tuple]:
    """The keys (date, place in the files) below which these shares of the rows lie, by a sample of the rows."""
    if not shares:
        return []
    keys = df.select(F.col(date).alias("date"), scan_position().alias("place"))
    every = max(1, keys.count() // sample)
    found = keys.filter(F.pmod(F.xxhash64("place"), F.lit(every)) == 0).orderBy("date", "place").collect()
    return [tuple(found[int(len(found) * share)]) for share in shares] if found else []


def _before(date: str, bound: tuple) -> Column:
    """Whether a row comes before a key of :func:`_bounds` in the order of :func:`range_split`, nulls first."""
    day, place = bound
    earlier = scan_position() < F.lit(place)
    if day is None:
        return F.col(date).isNull() & earlier
    return F.col(date).isNull() | (F.col(date) < F.lit(day)) | ((F.col(date) == F.lit(day)) & earlier)


def _move_parts(spark: SparkSession, source: str, target: str, first: int) -> None:
    """Move the part files of one write to a folder where their numbers begin at ``first``."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    files = place(source).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place(target))
    for found in files.globStatus(place(f"{source}/part-*")) or []:
        name = re.sub(r"^part-(\d+)", lambda m: f"part-{int(m[1]) + first:05d}", found.getPath().getName())
        if not files.rename(found.getPath(), place(f"{target}/{name}")):
            raise OSError(f"{found.getPath().toString()} can't be moved to {target}/{name}")


def part_number(file_path: Column) -> Column:
    """The position of a file among the files of one Spark write."""
    part = F.regexp_extract(file_path, r"part-(\d+)-", 1).cast("long")
    piece = F.coalesce(
        F.nullif(F.regexp_extract(file_path, r"\.?c(\d+)\.", 1), F.lit("")).cast("long"), F.lit(0))
    return part * F.lit(1_000_000) + piece


def slice_rows(df: DataFrame, order: list[str], low: int, high: int,
               parts: int | None = None) -> DataFrame:
    """Rows ``low`` (included) to ``high`` (excluded) in the given total order.

    The rows are range-partitioned, sorted and written once, a folder per part. A running
    sum over the row counts (one row per file) gives each file its first position; joining
    it on the part prunes the folders outside the slice. Nothing comes to the driver, and
    no step puts all rows in one task.
    """
    spark = df.sparkSession
    path = work_dir(spark, "slice")
    range_split(df, parts, *order, number="_part").write.partitionBy("_part").parquet(path)

    written = spark.read.schema(T.StructType([*df.schema, T.StructField("_part", T.IntegerType())])).parquet(path)
    written = written.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    earlier = Window.orderBy("_part", part_number(F.col("_file"))).rowsBetween(Window.unboundedPreceding, -1)
    files = stage(
        written.groupBy("_part", "_file").agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))), "slice-files")
    asked = files.filter((F.col("_start") < high) & (F.col("_start") + F.col("_rows") > low))
    position = F.col("_start") + F.col("_row")
    return (
        written.join(asked, ["_part", "_file"])
        .select(*df.columns, position.alias("position"))
        .filter((F.col("position") >= low) & (F.col("position") < high))
    )


def part_count(rows: int, rows_per_part: int = 1_000_000, least: int = 4) -> int:
    """How many part files a table of ``rows`` rows should have."""
    return max(least, -(-rows // rows_per_part))
