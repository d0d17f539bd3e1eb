"""Best-fit packing into bins of several permitted lengths.

Items go in by decreasing length, each into the open bin with the least room that still holds it;
if there is none, a bin of the permitted length with the least cost per token opens. Every bin
is at last cut down to the smallest permitted length that holds its contents. The permitted lengths are
optimised jointly: the packing is tried with each of them as the largest length that may be
opened for filling up, and the one with the least total cost stays.

Each task packs its own rows in windows of ``window`` documents, so nothing is shuffled and a task's
memory is bounded; a repeated task gives the same bins.

Lengths are counts of token ids if a ``tokenizer`` file is named: the same ids as in
:mod:`salesflow.llm.tokens`, the end id included. The texts then pass the Arrow task, which keeps
only their lengths. Otherwise they are the column ``n_tokens``, or, without one, words and an end token.

Defined results: an item longer than the longest bin is cut into full bins and a rest (no token
is dropped); null lengths and lengths below 1 count as 1 (an end token); repeated and null
doc_ids are items of their own; an empty table gives no bins.
"""

from __future__ import annotations

import os
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.textscan import pieces
from salesflow.llm.tokens import Encoder

LENGTHS = (512, 1024, 2048, 4096, 8192)
WINDOW = 100_000
PIECE = 1 << 19  # bytes of text whose ids are counted at once
PIECE_ROWS = ("piece int, n_tokens int, doc_start bigint, bin_id bigint, bin_start int, "
              "capacity int")


def bin_costs(lengths: tuple[int, ...], overhead: int = 64) -> dict[int, float]:
    """The cost of a bin: its tokens and a fixed overhead per sequence."""
    return {n: float(n + overhead) for n in lengths}


def best_fit(items: np.ndarray, order: np.ndarray, costs: dict[int, float], largest: int
             ) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each item, tokens in each bin); bins for filling up have at most ``largest`` tokens."""
    allowed = sorted(costs)
    opens = {}  # for the smallest permitted length that holds an item: the length to open
    for low in allowed:
        choice = [n for n in allowed if low <= n <= largest] or [low]
        opens[low] = min(choice, key=lambda n: (costs[n] / n, -n))
    where = np.empty(len(items), np.int64)
    used: list[int] = []
    rooms: list[int] = []  # the distinct rooms of open bins, sorted
    bins: dict[int, list[int]] = {}  # room -> bins
    for i in order:
        n = int(items[i])
        at = bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            stack = bins[room]
            b = stack.pop()
            if not stack:
                del bins[room], rooms[at]
        else:
            room, b = opens[allowed[bisect_left(allowed, n)]], len(used)
            used.append(0)
        where[i] = b
        used[b] += n
        if room > n:
            if room - n not in bins:
                insort(rooms, room - n)
                bins[room - n] = []
            bins[room - n].append(b)
    return where, np.array(used, np.int64)


def pack(items: np.ndarray, costs: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each item, capacity of each bin) of the cheapest packing found."""
    allowed = np.array(sorted(costs))
    price = np.array([costs[n] for n in allowed.tolist()])
    order = np.argsort(-items, kind="stable")
    best = None
    for largest in allowed.tolist():
        where, used = best_fit(items, order, costs, largest)
        size = np.searchsorted(allowed, used)
        cost = float(price[size].sum())
        if best is None or cost <= best[0]:
            best = cost, where, allowed[size]
    return best[1], best[2]


def _pieces(lengths: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, piece number, tokens): full bins of an overlong item, then its rest."""
    count = -(-lengths // longest)
    row = np.repeat(np.arange(len(lengths)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return row, number, np.minimum(lengths[row] - number * longest, longest)


def _packed(batches: Iterator[pa.RecordBatch], costs: dict[int, float], window: int
            ) -> Iterator[pa.RecordBatch]:
    longest = max(costs)
    first_bin = TaskContext.get().partitionId() << 33
    held: list[pa.RecordBatch] = []

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal first_bin
        table = pa.Table.from_batches(held).combine_chunks()
        lengths = np.maximum(np.nan_to_num(table.column(1).to_numpy()).astype(np.int64), 1)
        row, number, tokens = _pieces(lengths, longest)
        where, capacity = pack(tokens, costs)
        order = np.lexsort((number, row, where))
        fill = np.cumsum(tokens[order]) - tokens[order]
        begins = np.r_[True, where[order][1:] != where[order][:-1]]
        start = np.empty(len(order), np.int64)
        start[order] = fill - np.maximum.accumulate(np.where(begins, fill, 0))
        columns = [table.column(0).combine_chunks().take(pa.array(row)), pa.array(number, pa.int32()),
                   pa.array(tokens, pa.int32()), pa.array(number * longest, pa.int64()),
                   pa.array(first_bin + where, pa.int64()), pa.array(start, pa.int32()),
                   pa.array(capacity[where], pa.int32())]
        names = ["doc_id", *(f.split()[0] for f in PIECE_ROWS.split(", "))]
        first_bin += len(capacity)
        held.clear()
        yield from pa.Table.from_arrays(columns, names=names).to_batches(max_chunksize=10_000)

    for batch in batches:
        for at in range(0, batch.num_rows, window):
            held.append(batch.slice(at, window))
            if sum(b.num_rows for b in held) >= window:
                yield from flush()
    if sum(b.num_rows for b in held):
        yield from flush()


def _id_counts(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, token ids and an end id) of rows (doc_id, text).

    The encoder goes with the task: workers are used again for other stages, which have no room for it.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core, and each thread its own memory
    known = Encoder(tokenizer)
    for batch in batches:
        counts = [known.encode(texts)[1] for _, texts in pieces(pc.fill_null(batch.column(1), ""), PIECE)]
        n = pa.array(np.concatenate([np.zeros(0, np.int64), *counts]) + 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), n], names=["doc_id", "n"])


def word_tokens(text: Column) -> Column:
    """The words of a text and an end token."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), "")
    return (F.size(words) + 1).cast("bigint")


def pack_documents(docs: DataFrame, n_tokens: Column | None = None,
                   lengths: tuple[int, ...] = LENGTHS, costs: dict[int, float] | None = None,
                   window: int = WINDOW, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, n_tokens, doc_start, bin_id, bin_start, capacity."""
    if not lengths or min(lengths) < 1:
        raise ValueError("permitted lengths must be positive")
    if tokenizer is not None and n_tokens is not None:
        raise ValueError("lengths come from n_tokens or from a tokenizer, not from both")
    prices = costs or bin_costs(tuple(sorted(set(lengths))))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = f"doc_id {kind}, {PIECE_ROWS}"
    if tokenizer is not None:
        return docs.select("doc_id", "text").mapInArrow(
            lambda b: _packed(_id_counts(b, tokenizer), prices, window), rows)
    sized = docs.select("doc_id", (word_tokens(F.col("text")) if n_tokens is None else n_tokens)
                        .cast("bigint").alias("n"))
    return sized.mapInArrow(lambda b: _packed(b, prices, window), rows)
