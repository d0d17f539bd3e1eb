"""Line dedup: hashed lines, range-partitioned with a secondary sort, and keep bitmaps.

1. Every line of at least ``min_chars`` becomes a row (h1, h2, doc_id, text hash, line number);
   its key (blanks stripped, A-Z lower-cased) is a 128-bit hash.
2. The rows are range-partitioned by (hash, document, line) and sorted, the largest doc_id first.
   A line that fills a third of the corpus so spreads over many partitions.
3. Each partition is read as a stream of batches: the first document of a key stays, the others are
   listed for dropping. Only the first and the last key of a batch may go on elsewhere; their first
   three documents are handed on. These keys are settled by a small aggregate, and its result goes to each
   partition that has lines of the key, so the lines of a very common key stay spread.
4. The dropped lines of a document become one compressed bitmap; no text is returned.

Defined results: null and empty texts have one empty line; rows with the same doc_id count as one
document, equal rows share their bitmap, a null doc_id is smaller than any other; columns other
than doc_id and text are carried through :func:`drop_lines` untouched, whatever their names. With ``row``, the name of
a column that numbers the rows, every row is a document of its own: for tables whose doc_ids are null or repeated.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.textscan import pieces, span_hashes
from salesflow.session import stage

LINE_ROWS = "h1 bigint, h2 bigint, doc bigint, text_hash bigint, line int"
STREAM_ROWS = "kind string, h1 bigint, h2 bigint, doc bigint, text_hash bigint, line int, part int"
NULL_DOC = -(1 << 63)  # stands for a null doc_id while lines are compared

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _stripped(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each span without the blanks at its ends."""
    solid = np.flatnonzero(~_BLANK[data])
    if not len(solid):
        return starts, starts
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends) - 1
    some = first <= last
    return (np.where(some, solid[np.minimum(first, len(solid) - 1)], starts),
            np.where(some, solid[np.maximum(last, 0)] + 1, starts))


def _line_rows(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, hashes = (np.asarray(batch.column(k)) for k in (0, 2))
        for first, texts in pieces(batch.column(1)):
            text = texts.cast(pa.large_string())
            borders = np.frombuffer(text.buffers()[1], np.int64, text.offset + len(text) + 1)
            borders = borders[text.offset:]
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[borders[0]:borders[-1]]
            if not len(data):
                continue
            borders = borders - borders[0]
            breaks = np.flatnonzero(data == 10)
            starts = np.unique(np.concatenate([borders[:-1], breaks + 1]))
            starts = starts[starts < len(data)]
            # a text that ends in a line break: the empty line behind it needs no row
            ends = np.append(starts[1:], len(data))
            ends = ends - (data[ends - 1] == 10)
            row = np.searchsorted(borders, starts, side="right") - 1
            line = np.searchsorted(breaks, starts) - np.searchsorted(breaks, borders[row])
            a, b = _stripped(data, starts, np.maximum(ends, starts))
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            long = np.flatnonzero(points[b] - points[a] >= min_chars)
            a, b, row = a[long], b[long], row[long]
            lower = _LOWER[data]
            yield pa.RecordBatch.from_arrays([
                pa.array(span_hashes(lower, a, b).view(np.int64)),
                pa.array(span_hashes(lower ^ np.uint8(0x55), a, b).view(np.int64)),
                pa.array(docs[first + row]), pa.array(hashes[first + row]),
                pa.array(line[long].astype(np.int32)),
            ], names=["h1", "h2", "doc", "text_hash", "line"])


def _keys(row: str | None) -> tuple[Column, Column]:
    """(document, which of its texts): the hash of the text, or the number of the row."""
    return (F.coalesce("doc_id", F.lit(NULL_DOC)).cast("bigint"),
            F.col(f"`{row}`").cast("bigint") if row else F.xxhash64(F.coalesce("text", F.lit(""))))


def line_rows(docs: DataFrame, min_chars: int, row: str | None = None) -> DataFrame:
    """The hashed lines of at least ``min_chars`` code points, stored."""
    doc, which = _keys(row)
    keyed = docs.select(doc.alias("doc"), F.coalesce("text", F.lit("")).alias("text"), which.alias("text_hash"))
    return stage(keyed.mapInArrow(lambda b: _line_rows(b, min_chars), LINE_ROWS), "lines")


def _stream(batches: Iterator[pa.RecordBatch], min_docs: int, by_row: bool) -> Iterator[pa.RecordBatch]:
    """Sorted rows in; ``drop`` rows, ``open`` rows and the documents (``doc`` rows) of open keys out.

    A key that lies inside a batch is settled at once: its first document stays, and the lines of
    the others go if there are ``min_docs``. The first and the last key of a batch may go on in the
    next batch or partition, so they stay open, with their first ``min_docs`` documents.
    """
    names = [f.split()[0] for f in STREAM_ROWS.split(", ")]
    part = TaskContext.get().partitionId()

    def rows(kind: str, columns: list[np.ndarray]) -> pa.RecordBatch:
        kinds = pa.array([kind] * len(columns[0]), pa.string())
        parts = pa.array(np.full(len(columns[0]), part, np.int32))
        return pa.RecordBatch.from_arrays([kinds, *map(pa.array, columns), parts], names=names)

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(c) for c in batch.columns]
        h1, h2, doc, which = cols[:4]
        new_key = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        new_doc = new_key | np.r_[True, doc[1:] != doc[:-1]]
        if by_row:
            new_doc |= np.r_[True, which[1:] != which[:-1]]
        begins, key = np.flatnonzero(new_key), np.cumsum(new_key) - 1
        place = np.cumsum(new_doc) - 1
        rank = place - place[begins][key]  # of the row's document within its key
        n_docs = np.maximum.reduceat(rank, begins) + 1
        edge = (key == 0) | (key == key[-1])
        drop = ~edge & (rank > 0) & (n_docs[key] >= min_docs)
        named = edge & new_doc & (rank < min_docs)
        for kind, chosen in (("drop", drop), ("open", edge), ("doc", named)):
            if chosen.any():
                yield rows(kind, [c[chosen] for c in cols])


def dropped_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, row: str | None = None) -> DataFrame:
    """(doc, text_hash, line) of every line that goes."""
    lines = line_rows(docs, min_chars, row)
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc(), F.col("text_hash"), F.col("line")]
    streams = (lines.repartitionByRange(*order).sortWithinPartitions(*order)
               .mapInArrow(lambda b: _stream(b, min_docs, row is not None), STREAM_ROWS))
    settled = stage(streams, "line-stream")
    which = F.col("text_hash") if row else F.lit(0).cast("bigint")
    first = F.struct(F.col("doc").alias("doc"), (-which).alias("before"))  # the largest doc_id, its first row
    named = settled.filter("kind = 'doc'")
    keys = (named.select("h1", "h2", first.alias("d"), "part").distinct()
            .groupBy("h1", "h2").agg(F.max("d").alias("kept"), F.count_distinct("d").alias("n_docs"),
                                     F.collect_set("part").alias("parts"))
            .filter(F.col("n_docs") >= min_docs)
            .select("h1", "h2", "kept", F.explode("parts").alias("part")))
    late = settled.filter("kind = 'open'").join(keys, ["h1", "h2", "part"]).filter(first != F.col("kept"))
    columns = ["doc", "text_hash", "line"]
    return settled.filter("kind = 'drop'").select(columns).unionByName(late.select(columns))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bitmaps = []
        for lines in batch.column(2).to_pylist():
            keep = np.ones(-(-(max(lines) + 1) // 8) * 8, np.uint8)
            keep[lines] = 0
            bitmaps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(bitmaps, pa.binary())],
            names=["doc", "text_hash", "keep"])


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, row: str | None = None) -> DataFrame:
    """(doc, text_hash, keep) of every document that loses a line, stored.

    ``keep`` is a zlib-compressed bit string, one bit per line from the first one, 1: stays;
    lines behind its end stay.
    """
    gathered = dropped_lines(docs, min_chars, min_docs, row).groupBy("doc", "text_hash").agg(
        F.collect_set("line").alias("lines"))
    return stage(gathered.mapInArrow(_bitmaps, "doc bigint, text_hash bigint, keep binary"),
                 "keep-bitmaps")


def kept_lines(text: str, keep: bytes | None) -> tuple[str, int, int]:
    """The text that a bitmap keeps, its number of lines before, and how many went."""
    lines = text.split("\n")
    if keep is None:
        return text, len(lines), 0
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[:len(lines)]
    gone = set(np.flatnonzero(bits == 0).tolist())
    return "\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, row: str | None = None) -> DataFrame:
    """All columns of ``docs`` and, as the last one, the bitmap of the row or null."""
    doc, which, keep = _free(docs.columns, "doc", "which", "keep")
    keyed = docs.withColumns(dict(zip((doc, which), _keys(row), strict=True)))
    named = bitmaps.select(F.col("doc").alias(doc), F.col("text_hash").alias(which), F.col("keep").alias(keep))
    return keyed.join(named, [doc, which], "left").select(*[f"`{c}`" for c in docs.columns], keep)


def _free(taken: list[str], *wanted: str) -> list[str]:
    """Names that no column has."""
    lower = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name in lower:
            name = "_" + name
        out.append(name)
    return out


def _applied(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([
            None if t is None else kept_lines(t, k)[0]
            for t, k in zip(batch.column(place).to_pylist(), batch.column(-1).to_pylist(),
                            strict=True)], pa.string())
        columns = batch.columns[:-1]
        columns[place] = texts
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])


def drop_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, row: str | None = None) -> DataFrame:
    """``docs`` with the texts that the bitmaps keep; all columns stay, null texts stay null."""
    joined = with_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs, row), row)
    place = joined.columns.index("text")
    return joined.mapInArrow(lambda b: _applied(b, place), docs.schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_lines, n_dropped, digest = [], [], []
        for text, keep in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            kept, total, gone = kept_lines(text or "", keep)
            n_lines.append(total)
            n_dropped.append(gone)
            digest.append(hashlib.sha256(kept.encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
             pa.array(digest, pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def line_digests(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the hash of the text that the bitmaps keep, per row."""
    joined = with_bitmaps(docs.select("doc_id", "text"), bitmaps)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        _digests, f"doc_id {kind}, n_lines bigint, n_dropped bigint, kept_sha256 string")
