"""The message bus: publish rows as JSON messages, subscribe to them.

In use a topic is a Kafka topic (the connector must be on the classpath). A
folder of message files is a drop-in topic without a broker.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter, StreamingQuery

from salesflow import schemas
from salesflow.functions.wire import as_text, encode
from salesflow.sources.log import read_json

MESSAGE = T.StructType([T.StructField("value", T.StringType(), True)])


@dataclass(frozen=True)
class Topic:
    """Where messages go to and come from."""

    format: str
    options: dict[str, str] = field(default_factory=dict)

    @classmethod
    def kafka(cls, servers: str, name: str, **options: str) -> Topic:
        return cls("kafka", {"kafka.bootstrap.servers": servers, "topic": name, **options})

    @classmethod
    def folder(cls, path: str) -> Topic:
        return cls("parquet", {"path": path})


def _every(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """A micro-batch each ``every`` (``"5 seconds"``); None: all there is, then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def stream_sales(spark: SparkSession, folder: str, schema: T.StructType = schemas.SALE,
                 files_per_trigger: int | None = None, bytes_per_trigger: int | None = None) -> DataFrame:
    """Watch a folder of parquet files with a declared schema.

    ``files_per_trigger`` or ``bytes_per_trigger`` paces the feed; files are taken in the
    order in which they appeared.
    """
    return _paced(spark.readStream.schema(schema), files_per_trigger, bytes_per_trigger).parquet(folder)


def _paced(reader: DataStreamReader, files: int | None, size: int | None) -> DataStreamReader:
    """A bound on one micro-batch of files: their number or their bytes (at least one file is taken).

    Bytes hold whatever the files' sizes are: more input makes more micro-batches, not larger ones.
    """
    if files and size:
        raise ValueError("a micro-batch is bounded by files or by bytes, not by both")
    if files:
        return reader.option("maxFilesPerTrigger", files)
    return reader.option("maxBytesPerTrigger", size) if size else reader


def release_parts(spark: SparkSession, parts: str, watched: str, numbers: Iterable[int],
                  schema: T.StructType = schemas.SALE) -> None:
    """One tick of a paced replay: deliver some parts, by number, to a watched folder."""
    asked = set(numbers)
    # one pattern, so that the folder is listed once per tick
    released = spark.read.schema(schema).parquet(f"{parts}/part-{{{','.join(f'{n:05d}' for n in sorted(asked))}}}-*")
    missing = asked - set(part_numbers(released))
    if missing:
        raise FileNotFoundError(f"{parts} has no parts {sorted(missing)}")
    released.write.mode("append").parquet(watched)


def part_numbers(parts: DataFrame) -> list[int]:
    """The numbers of the part files that a frame reads, in order; a range without rows has left no file."""
    return sorted({int(re.search(r"part-(\d+)-[^/]*$", file)[1]) for file in parts.inputFiles()})


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a started stream's checkpoint; another checkpoint, another id."""
    return read_json(spark, f"{checkpoint}/metadata")["id"]


def publish(stream: DataFrame, topic: Topic, checkpoint: str,
            every: str | None = "5 seconds") -> StreamingQuery:
    """Append every row of a stream to a topic as one JSON message.

    In a folder topic each publisher has a folder of its own, with one folder per
    micro-batch: several publishers, and files put there by others, do not touch each
    other. A batch that was stored whole is not stored again when it is repeated.
    """
    messages = encode(stream)
    if topic.format != "kafka":
        folder = stream.sparkSession._jvm.org.apache.hadoop.fs.Path(topic.options["path"])
        folder.getFileSystem(stream.sparkSession._jsc.hadoopConfiguration()).mkdirs(folder)

        def store(rows: DataFrame, batch_id: int) -> None:
            spark = rows.sparkSession
            path = f"{topic.options['path']}/stream={stream_id(spark, checkpoint)}/batch_id={batch_id}"
            done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
            if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
                rows.write.mode("overwrite").option("compression", "zstd").format(topic.format).save(path)

        return for_each_batch(messages, store, checkpoint, every)
    writer = (
        messages.writeStream.format(topic.format).options(**topic.options)
        .outputMode("append").option("checkpointLocation", checkpoint)
    )
    return _every(writer, every).start()


def subscribe(spark: SparkSession, topic: Topic, start: str = "earliest",
              group: str | None = None, per_trigger: int | None = None,
              bytes_per_trigger: int | None = None) -> DataFrame:
    """The messages of a topic as text in ``value``.

    ``start`` and ``group`` apply to brokers: where a first start begins, and
    the consumer group. ``per_trigger`` bounds a micro-batch (offsets or files),
    ``bytes_per_trigger`` that of a folder by the size of its files.
    """
    reader = spark.readStream.format(topic.format)
    if topic.format == "kafka":
        options = dict(topic.options)
        options["subscribe"] = options.pop("topic")
        options["startingOffsets"] = start
        if group:
            options["kafka.group.id"] = group
        if bytes_per_trigger:
            raise ValueError("a broker's micro-batches are bounded by offsets (per_trigger)")
        if per_trigger:
            options["maxOffsetsPerTrigger"] = str(per_trigger)
        messages = reader.options(**options).load()
    else:
        # publishers' folders are no columns of the messages
        reader = _paced(reader, per_trigger, bytes_per_trigger).schema(MESSAGE).option("recursiveFileLookup", "true")
        messages = reader.load(topic.options["path"])
    return as_text(messages).select("value")


def for_each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                   every: str | None = None) -> StreamingQuery:
    """Run ``write(rows, batch_id)`` per micro-batch, resuming from saved offsets.

    A batch that failed is run again with the same id and the same rows, so
    ``write`` must replace what that id has written before. Its errors end the
    query; nothing is swallowed.
    """
    writer = (
        stream.writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    return _every(writer, every).start()
