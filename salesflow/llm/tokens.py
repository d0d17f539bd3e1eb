"""Token ids of a corpus in one ordered, compressed, checked file set.

1. The documents are range-partitioned by doc_id (ties by text) and sorted; each task encodes its
   texts with the tokenizers library and stores the ids, with its count of every id.
2. The counts of all documents give one frequency table, no larger than the vocabulary.
3. The ids are encoded in blocks of whole documents (:mod:`salesflow.llm.rans`) and stored as
   ``blocks`` beside ``table``. Blocks are ordered by (part, seq); every block decodes on its own.
4. The reader decodes blocks in parallel, checks their checksums, and adds what stands before them.

The library is slow on long texts, and words repeat. So a text is cut into the tokenizer's own
pre-tokens by a vectorised scan, the library encodes each distinct pre-token once per worker (a bounded
memory), and the ids are gathered. A text with a character outside the scan's range (beyond U+024F,
control characters, contractions, special tokens) goes to the library as a whole.

Defined results: null text counts as empty and has the end id alone; documents are ordered by
doc_id, null first, then by text, however many parts there are; repeated rows are written as often as they occur; only doc_id
and text are read.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from salesflow.llm import rans
from salesflow.llm.textscan import pieces, span_hashes
from salesflow.session import work_dir

END_ID = 0
BLOCK_IDS = 1 << 20
SLOTS = 1 << 20  # pre-tokens that a worker finds again at once
ROW = 1024  # new pre-tokens that are encoded as one text
KNOWN_WORDS = 2 << 20  # encoded pre-tokens after which a worker starts anew

_OTHER, _LETTER, _NUMBER, _SPACE, _ODD = range(5)


def _kind(point: int) -> int:
    """The class of a character in the tokenizer's pattern; ``_ODD``: leave it to the library."""
    if point in (0x20, *range(0x09, 0x0E)):
        return _SPACE
    if point < 0x20 or 0x7F <= point <= 0xA0:
        return _ODD
    category = unicodedata.category(chr(point))
    if category == "Cn":
        return _ODD
    return {"L": _LETTER, "N": _NUMBER, "Z": _ODD}.get(category[0], _OTHER)


_LAST = 0x250
_POINT_KINDS = np.array([_kind(p) for p in range(_LAST)] + [_ODD] * (0x800 - _LAST), np.uint8)
# contractions and special tokens are cut differently
_LEFT_OUT = r"'(?:[stmd]|re|ve|ll)|<\|"


def char_kinds(data: np.ndarray) -> np.ndarray:
    """The class of the character that each byte of UTF-8 text belongs to."""
    kinds = _POINT_KINDS[data & 0x7F]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        point = ((data[lead].astype(np.int32) & 0x1F) << 6) | (data[lead + 1] & 0x3F)
        kind = np.where(data[lead] < 0xE0, _POINT_KINDS[point], _ODD)
        kinds[data >= 0x80] = _ODD
        kinds[lead] = kind
        kinds[lead + 1] = kind
    return kinds


def pre_tokens(data: np.ndarray, kinds: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """The starts of the pre-tokens of texts that lie one after the other in ``data``."""
    cut = np.empty(len(data), bool)
    cut[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=cut[1:])
    cut[borders[:-1][borders[:-1] < len(data)]] = True
    begins = np.flatnonzero(cut)
    ends = np.append(begins[1:], len(data))
    space = kinds[begins] == _SPACE
    # a run of blanks before a word gives its last blank away: to the word if it is a space
    closes = np.zeros(len(data) + 1, bool)
    closes[borders] = True
    gives = np.flatnonzero(space & ~closes[ends])
    last = ends[gives] - 1
    cut[last] = True
    cut[ends[gives][data[last] == 0x20]] = False
    return np.flatnonzero(cut)


def library(path: str):
    """The tokenizer of a file; the package is needed only here."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Token ids of many texts; remembers the ids of the pre-tokens that it has met."""

    def __init__(self, path: str) -> None:
        self.library = library(path)
        words = self.library.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(words.values()) + 1, np.int64)  # bytes of each id: one per character
        self.sizes[list(words.values())] = [len(w) for w in words]
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)  # the pre-token that a slot holds
        self.place = np.zeros(SLOTS, np.int32)
        self.begin, self.count = np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int32)
        self.flat = np.zeros(1 << 12, np.int32)
        self.words = self.used = 0

    def _learn(self, spans: list[bytes], lettered: int) -> None:
        """Encode pre-tokens, the first ``lettered`` of them many in one text."""
        rows = [spans[a:min(a + ROW, lettered)] for a in range(0, lettered, ROW)]
        texts = [b"".join(r).decode() for r in rows]
        for found, row in zip(self._encoded(texts), rows, strict=True):
            ids = np.array(found.ids, np.int32)
            reached = np.cumsum(self.sizes[ids])
            ends = np.cumsum(np.fromiter(map(len, row), np.int64, len(row)))
            last = np.searchsorted(reached, ends)
            if last[-1] < len(reached) and np.array_equal(reached[last], ends):
                self._append(np.diff(last, prepend=-1), ids)
            else:  # an id reaches over the end of a pre-token
                self._append_each(row)
        self._append_each(spans[lettered:])

    def _encoded(self, texts: list[str]) -> list:
        return self.library.encode_batch_fast(texts, add_special_tokens=False)

    def _append_each(self, spans: list[bytes]) -> None:
        ids = [e.ids for e in self._encoded([x.decode() for x in spans])]
        self._append(np.fromiter(map(len, ids), np.int32, len(ids)),
                     np.fromiter(chain.from_iterable(ids), np.int32))

    def _append(self, counts: np.ndarray, ids: np.ndarray) -> None:
        words, used = self.words + len(counts), self.used + len(ids)
        self.begin, self.count = _grown(self.begin, words), _grown(self.count, words)
        self.flat = _grown(self.flat, used)
        self.begin[self.words:words] = self.used + np.cumsum(counts) - counts
        self.count[self.words:words] = counts
        self.flat[self.used:used] = ids
        self.words, self.used = words, used

    def _places(self, keys: np.ndarray, data: np.ndarray, kinds: np.ndarray, starts: np.ndarray,
                ends: np.ndarray) -> np.ndarray:
        """The number of each pre-token among the known ones; new ones are encoded."""
        slot = (keys & np.uint64(SLOTS - 1)).astype(np.int32)
        out = self.place[slot]
        missed = np.flatnonzero(self.keys[slot] != keys)
        if len(missed):
            some, first, back = np.unique(keys[missed], return_index=True, return_inverse=True)
            at = missed[first]
            # a space and letters: such pre-tokens in a row are cut again in the same places
            second = np.minimum(starts[at] + 1, ends[at] - 1)
            lettered = (data[starts[at]] == 0x20) & (kinds[second] == _LETTER)
            row = np.concatenate([np.flatnonzero(lettered), np.flatnonzero(~lettered)])
            new = np.empty(len(some), np.int32)
            new[row] = self.words + np.arange(len(some))
            raw = data.tobytes()
            spans = [raw[a:b] for a, b in zip(starts[at[row]].tolist(), ends[at[row]].tolist(),
                                              strict=True)]
            self._learn(spans, int(lettered.sum()))
            out[missed] = new[back]
            self.keys[slot[at]] = some
            self.place[slot[at]] = new
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids of each text) of texts without nulls."""
        if self.words > KNOWN_WORDS:
            self._forget()
        text = texts.cast(pa.large_string())
        borders = np.frombuffer(text.buffers()[1], np.int64, text.offset + len(text) + 1)[text.offset:]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[borders[0]:borders[-1]]
        borders = borders - borders[0]
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        kinds = char_kinds(data)
        odd = np.asarray(pc.match_substring_regex(text, _LEFT_OUT)).copy()
        strange = np.flatnonzero(kinds == _ODD)
        odd[np.searchsorted(borders, strange, side="right") - 1] = True
        if odd.any():
            return self._mixed(texts, odd)
        starts = pre_tokens(data, kinds, borders)
        ends = np.append(starts[1:], len(data))
        place = self._places(span_hashes(data, starts, ends), data, kinds, starts, ends)
        counts = self.count[place]
        before = np.concatenate([[0], np.cumsum(counts)])
        take = np.repeat(self.begin[place] - before[:-1], counts) + np.arange(before[-1])
        bounds = before[np.searchsorted(starts, borders)]
        return self.flat[take], np.diff(bounds)

    def _mixed(self, texts: pa.Array, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Some texts by the scan, the odd ones by the library."""
        ids: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        plain = np.flatnonzero(~odd)
        if len(plain):
            all_ids, counts = self.encode(texts.take(pa.array(plain)))
            for i, part in zip(plain.tolist(), np.split(all_ids, np.cumsum(counts)[:-1]), strict=True):
                ids[i] = part
        rest = np.flatnonzero(odd)
        found = self._encoded(texts.take(pa.array(rest)).to_pylist())
        for i, e in zip(rest.tolist(), found, strict=True):
            ids[i] = np.array(e.ids, np.int32)
        return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)


_encoders: dict[str, Encoder] = {}  # of this worker process: later tasks know the words already


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _grown(have: np.ndarray, need: int) -> np.ndarray:
    return have if need <= len(have) else np.concatenate([have, np.zeros(max(need, len(have)), have.dtype)])


def _token_rows(batches: Iterator[pa.RecordBatch], path: str, vocabulary: int) -> Iterator[pa.RecordBatch]:
    """A row of ids for each document, then a row for each id's count in this task."""
    known = encoder(path)
    part = TaskContext.get().partitionId()
    width = np.uint16 if vocabulary <= 1 << 16 else np.uint32
    totals = np.zeros(vocabulary, np.int64)
    seq = 0

    def made(ids, seqs, payloads, tokens, counts) -> pa.RecordBatch:
        n = len(seqs)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, part, np.int32)), seqs, ids, payloads, tokens, counts],
            names=["part", "seq", "doc_id", "ids", "token", "count"])

    kind = pa.int64()
    for batch in batches:
        kind = batch.schema.field(0).type
        for first, texts in pieces(pc.fill_null(batch.column(1), "")):
            ids, counts = known.encode(texts)
            totals += np.bincount(ids, minlength=vocabulary)
            totals[END_ID] += len(texts)
            bounds = np.concatenate([[0], np.cumsum(counts)]).tolist()
            narrow = ids.astype(width)
            end = width(END_ID).tobytes()
            payloads = [narrow[a:b].tobytes() + end for a, b in zip(bounds, bounds[1:], strict=False)]
            n = len(texts)
            yield made(batch.column(0).slice(first, n), pa.array(np.arange(seq, seq + n)),
                       pa.array(payloads, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()))
            seq += n
    used = np.flatnonzero(totals)
    yield made(pa.nulls(len(used), kind), pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.binary()),
               pa.array(used.astype(np.int32)), pa.array(totals[used]))


def _block_rows(batches: Iterator[pa.RecordBatch], freq: np.ndarray, width: type) -> Iterator[pa.RecordBatch]:
    """Blocks of whole documents of one part, in order."""
    table = rans.Table.of(freq)
    held: list[tuple] = []
    size = 0

    def flush(part: int) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(h[2] for h in held), width)
        counts = [len(h[2]) // np.dtype(width).itemsize for h in held]
        row = pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([held[0][0]], pa.int64()),
             pa.array([len(ids)], pa.int64()), pa.array([[h[1] for h in held]], pa.list_(kind)),
             pa.array([counts], pa.list_(pa.int64())), pa.array([rans.encode(ids, table)], pa.binary())],
            names=["part", "seq", "n_ids", "doc_ids", "counts", "block"])
        held.clear()
        return row

    kind, open_part = pa.int64(), -1
    for batch in batches:
        kind = batch.schema.field(2).type
        parts, seqs, docs, ids = (c.to_pylist() for c in batch.columns[:4])
        for part, seq, doc, payload in zip(parts, seqs, docs, ids, strict=True):
            if held and (part != open_part or seq != held[-1][0] + 1 or size >= BLOCK_IDS):
                yield flush(open_part)
                size = 0
            open_part = part
            held.append((seq, doc, payload))
            size += len(payload) // np.dtype(width).itemsize
    if held:
        yield flush(open_part)


def write_tokens(docs: DataFrame, tokenizer: str, path: str, bits: int = 20) -> None:
    """Encode ``docs`` (doc_id, text) into ``path``/blocks and ``path``/table."""
    spark = docs.sparkSession
    vocabulary = library(tokenizer).get_vocab_size(with_added_tokens=True)
    kind = docs.schema["doc_id"].dataType.simpleString()
    width = np.uint16 if vocabulary <= 1 << 16 else np.uint32
    by_id, text = F.col("doc_id").asc_nulls_first(), F.col("text")
    # parts are cut by the beginning of the text, which orders like the text: borders stay small
    ordered = (docs.select("doc_id", "text")
               .repartitionByRange(by_id, F.substring(text, 1, 64).asc_nulls_first())
               .sortWithinPartitions(by_id, text.asc_nulls_first()))
    raw = f"{path}/raw"
    ordered.mapInArrow(
        lambda b: _token_rows(b, tokenizer, vocabulary),
        f"part int, seq bigint, doc_id {kind}, ids binary, token int, count bigint",
    ).write.option("compression", "zstd").parquet(raw)
    stored = spark.read.parquet(raw)
    counts = (stored.filter("token IS NOT NULL").groupBy("token").agg(F.sum("count").alias("n"))
              .toArrow())  # at most one row per id of the vocabulary
    totals = np.zeros(vocabulary, np.int64)
    totals[np.asarray(counts.column("token"))] = np.asarray(counts.column("n"))
    totals[END_ID] = max(totals[END_ID], 1)
    freq = rans.scaled(totals, max(bits, vocabulary.bit_length() + 1))
    rows = [(int(i), int(freq[i])) for i in np.flatnonzero(freq)]
    spark.createDataFrame(rows, "token int, freq bigint").coalesce(1).write.parquet(f"{path}/table")
    stored.filter("ids IS NOT NULL").select("part", "seq", "doc_id", "ids").mapInArrow(
        lambda b: _block_rows(b, freq, width),
        f"part int, seq bigint, n_ids bigint, doc_ids array<{kind}>, counts array<bigint>, block binary",
    ).write.option("compression", "none").parquet(f"{path}/blocks")


def _read_blocks(batches: Iterator[pa.RecordBatch], freq: np.ndarray) -> Iterator[pa.RecordBatch]:
    table = rans.Table.of(freq)
    for batch in batches:
        for k in range(batch.num_rows):
            ids = rans.decode(batch.column(4)[k].as_py(), table).astype("<u4")
            counts = np.asarray(batch.column(3)[k].values).astype(np.int64)
            before = np.cumsum(counts) - counts
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * (a + n)])
                   for a, n in zip(before.tolist(), counts.tolist(), strict=True)]
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, batch.column(0)[k].as_py(), np.int32)),
                 pa.array(np.full(n, batch.column(1)[k].as_py(), np.int64)),
                 batch.column(2)[k].values, pa.array(before), pa.array(counts),
                 pa.array(crc, pa.int64())],
                names=["part", "seq", "doc_id", "before", "n_tokens", "ids_crc32"])


def block_offsets(blocks: DataFrame) -> DataFrame:
    """(part, seq, base): the ids before each block; parts and blocks are few, no id is read."""
    sizes = blocks.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    first = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return sizes.withColumn("inside", inside).join(first, "part").select(
        "part", "seq", (F.col("first") + F.col("inside")).alias("base"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""
    table = spark.read.parquet(f"{path}/table").toArrow()
    freq = np.zeros(int(pc.max(table.column("token")).as_py()) + 1, np.int64)
    freq[np.asarray(table.column("token"))] = np.asarray(table.column("freq"))
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    found = blocks.select("part", "seq", "doc_ids", "counts", "block").mapInArrow(
        lambda b: _read_blocks(b, freq),
        f"part int, seq bigint, doc_id {kind}, before bigint, n_tokens bigint, ids_crc32 bigint")
    offsets = work_dir(spark, "token-offsets")
    block_offsets(blocks).write.parquet(offsets)
    joined = found.join(spark.read.parquet(offsets), ["part", "seq"])
    return joined.select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens",
                         "ids_crc32")
