"""Records of quoted CSV files, cut by any number of tasks.

A line break within quotes is no end of a record, and whether a place of a file is within quotes depends on
everything before it. Here no task reads more than its splits:

1. A line is a function from the state before it (outside or inside a quoted field) to the state after it.
   The functions of a split are composed while its lines stream by: one row per split.
2. A window over these rows composes them in file order. That gives the state each split begins in and, if it begins
   inside a field, the line at which that record was opened.
3. The splits are read again. A line that begins and ends outside is a record; the lines of broken records, and only
   these, are shuffled and put together.

Defined results: a quote opens a field only at its beginning (elsewhere it is text), ``""`` within quotes is a quote,
what follows a closing quote is text up to the next separator. Lines end with \\n; a \\r at the end of a record is
dropped, within a field it stays. Blank lines between records are none. The first record of each file is its header.
A quote that is never closed, and a record of more than ``longest`` bytes, are no records: their lines are returned
one by one with ``torn`` true, so that one such quote never gathers the rest of a file in a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesflow.session import stage

LONGEST = 16 << 20


def _patterns(sep: str) -> tuple[str, str]:
    """What a line looks like that ends outside quotes, if it begins outside or inside of them."""
    cut = re.escape(sep)
    text = f'[^"{cut}][^{cut}]*'
    quoted = f'(?:[^"]|"")*"(?:{text})?'
    more = f'(?:{cut}(?:"{quoted}|{text})?)*$'
    return f'^(?:"{quoted}|{text})?{more}', f"^{quoted}{more}"


class Split:
    """The state and the last opened record at the current line, for both states a split may begin in."""

    def __init__(self, key: tuple[int, int]) -> None:
        self.key, self.lines = key, 0
        self.state, self.opened = [0, 1], [-1, -1]

    def pass_lines(self, outside: np.ndarray, inside: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(state before, state after, last opener) of the next lines, for both beginnings.

        ``outside`` and ``inside`` hold the state after each line, by the state before it.
        """
        place = np.arange(len(outside))
        fixed = np.maximum.accumulate(np.where(outside == inside, place, -1))
        turns = np.cumsum((outside == 1) & (inside == 0))
        result = []
        for s in (0, 1):
            known = fixed >= 0
            base = np.where(known, outside[fixed], self.state[s])
            after = base ^ ((turns - np.where(known, turns[fixed], 0)) & 1)
            before = np.append(self.state[s], after[:-1])
            opener = np.where((before == 0) & (after == 1), self.lines + place, -1)
            opener = np.maximum(np.maximum.accumulate(opener), self.opened[s])
            result.append((before, after, opener))
            self.state[s], self.opened[s] = int(after[-1]), int(opener[-1])
        self.lines += len(place)
        return result


def _passed(batches: Iterator[pa.RecordBatch], sep: str) -> Iterator[tuple]:
    """(split, first line, its lines, what ``pass_lines`` says); None for the lines at the end of a split."""
    ends_out, ends_in = _patterns(sep)
    split = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        value = batch.column(2)
        outside, inside = np.zeros(len(value), np.int64), np.ones(len(value), np.int64)
        quoted = np.flatnonzero(pc.match_substring(value, '"').to_numpy(zero_copy_only=False))
        if len(quoted):
            some = value.take(pa.array(quoted))
            outside[quoted] = ~pc.match_substring_regex(some, ends_out).to_numpy(zero_copy_only=False)
            inside[quoted] = ~pc.match_substring_regex(some, ends_in).to_numpy(zero_copy_only=False)
        new = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
        for a, b in zip(np.r_[0, new].tolist(), np.r_[new, len(value)].tolist(), strict=True):
            key = int(file[a]), int(start[a])
            if split is None or split.key != key:
                if split:
                    yield split, None, None, None
                split = Split(key)
            first = split.lines
            yield split, first, value.slice(a, b - a), split.pass_lines(outside[a:b], inside[a:b])
    if split:
        yield split, None, None, None


def split_states(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Stored: (file, split, from_split, from_line) of the splits that begin inside a field, and where it was opened."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, first, _, _ in _passed(batches, sep):
            if first is None:
                yield pa.RecordBatch.from_pylist([{
                    "file": split.key[0], "split": split.key[1], "e0": split.state[0], "e1": split.state[1],
                    "o0": split.opened[0], "o1": split.opened[1]}])

    ends = stage(lines.mapInArrow(
        summed, "file bigint, split bigint, e0 bigint, e1 bigint, o0 bigint, o1 bigint"), "split-ends")
    order = Window.partitionBy("file").orderBy("split")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.when((F.col("e0") == 1) & (F.col("e1") == 0), 1).otherwise(0)
    counted = ends.withColumn("turns", F.sum(turned).over(so_far))
    fixed = F.when(F.col("e0") == F.col("e1"), F.struct(F.col("e0").alias("state"), "turns"))
    known = counted.withColumns({
        "known": F.last(fixed, ignorenulls=True).over(earlier),
        "before": F.coalesce(F.last("turns").over(earlier), F.lit(0))})
    state = (F.coalesce("known.state", F.lit(0)) + F.col("before") - F.coalesce("known.turns", F.lit(0))) % 2
    opened = known.withColumn("state", state).withColumn(
        "opened", F.when(F.col("state") == 0, F.col("o0")).otherwise(F.col("o1")))
    own = F.when(F.col("opened") >= 0, F.struct("split", F.col("opened").alias("line")))
    return stage(
        opened.withColumn("origin", F.last(own, ignorenulls=True).over(earlier)).filter("state = 1")
        .select("file", "split", F.col("origin.split").alias("from_split"), F.col("origin.line").alias("from_line")),
        "split-states")


def csv_records(spark: SparkSession, path: str, sep: str = ",", longest: int = LONGEST) -> DataFrame:
    """(record, torn): the records of headed CSV files without their headers, see above."""
    kind = ("file bigint, split bigint, line bigint, value binary, "
            "b0 bigint, b1 bigint, a0 bigint, a1 bigint, o0 bigint, o1 bigint")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("value"))
    states = split_states(lines, sep)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for split, first, value, passed in _passed(batches, sep):
            if first is not None:
                n = len(value)
                keys = [pa.array(np.full(n, k, np.int64)) for k in split.key]
                (b0, a0, o0), (b1, a1, o1) = passed
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(np.arange(first, first + n)), value,
                     *(pa.array(c.astype(np.int64)) for c in (b0, b1, a0, a1, o0, o1))],
                    names=["file", "split", "line", "value", "b0", "b1", "a0", "a1", "o0", "o1"])

    begun = F.col("from_line").isNotNull()

    def by_state(name: str):
        return F.when(begun, F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    # few splits begin inside a field: a small table, which Spark broadcasts if its size allows
    known = lines.mapInArrow(placed, kind).join(states, ["file", "split"], "left").select(
        "file", "split", "line", F.col("value").cast("string").alias("value"), "from_split", "from_line",
        by_state("b").alias("before"), by_state("a").alias("after"), by_state("o").alias("opener"))
    single = (F.col("before") == 0) & (F.col("after") == 0)
    here = F.col("opener") >= 0
    parts = stage(known.filter(~single).select(
        "file", F.when(here, F.col("split")).otherwise(F.col("from_split")).alias("from_split"),
        F.when(here, F.col("opener")).otherwise(F.col("from_line")).alias("from_line"),
        "split", "line", "value", "after"), "broken-records")
    key = ["file", "from_split", "from_line"]
    bytes_ = F.sum(F.octet_length("value") + 1)
    bad = stage(parts.groupBy(*key).agg(F.min("after").alias("open"), bytes_.alias("bytes")).filter(
        (F.col("open") == 1) | (F.col("bytes") > longest)).select(*key), "torn-records")
    joined = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("split", "line", "value"))), lambda x: x["value"]), "\n")
    header = (F.col("from_split") == 0) & (F.col("from_line") == 0)
    whole = known.filter(single & ~((F.col("split") == 0) & (F.col("line") == 0)) & (F.trim("value", F.lit(" \t\r")) != "")).select(
        F.col("value").alias("record"), F.lit(False).alias("torn"))
    broken = parts.join(bad, key, "left_anti").groupBy(*key).agg(joined.alias("record")).filter(~header).select(
        "record", F.lit(False).alias("torn"))
    torn = parts.join(bad, key, "left_semi").select(F.col("value").alias("record"), F.lit(True).alias("torn"))
    return whole.unionByName(broken).unionByName(torn).withColumn("record", F.regexp_replace("record", r"\r\z", ""))
