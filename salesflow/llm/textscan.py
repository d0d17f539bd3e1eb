"""Vectorised scans over the bytes of many texts at once, for use inside Arrow tasks.

A batch of texts becomes one byte buffer in which every text stands between two blanks, so that
nothing found inside a word can reach over the border of two texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
PIECE_BYTES = 1 << 20
HASH_BYTES = 1 << 17  # symbols whose spans are hashed at once

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: dict[int, np.ndarray] = {}


def lower_table() -> np.ndarray:
    """Byte table that lower-cases A-Z and turns every ASCII blank into a space."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    table[list(BLANKS)] = 0x20
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) with at most ``limit`` bytes each; a longer text stands alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, before + limit, side="right")), first + 1)
        yield first, texts.slice(first, last - first)
        first = last


def padded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ' ' + text + ' ' of all rows (null: empty) and the n + 1 borders."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    blank, nothing = (pa.scalar(s, pa.large_string()) for s in (" ", ""))
    wide = pc.binary_join_element_wise(blank, filled, blank, nothing)
    if isinstance(wide, pa.ChunkedArray):
        wide = wide.combine_chunks()
    offsets = np.frombuffer(wide.buffers()[1], np.int64, len(wide) + 1 + wide.offset)[wide.offset:]
    data = np.frombuffer(wide.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; the mask must begin and end with False."""
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return edges[0::2], edges[1::2]


def _power(count: int, base: int) -> np.ndarray:
    """The first powers of a base, at most ``HASH_BYTES`` and one of them."""
    have = _powers.get(base)
    if have is None:
        steps = np.full(HASH_BYTES + 1, base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:count]


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of symbols: a polynomial, then mixed with the length.

    Spans come in order and don't overlap. They are hashed in blocks of ``HASH_BYTES``, so what is
    needed beside the result does not grow with the symbols, nor with the longest span.
    """
    found = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        begin = int(starts[first])
        last = int(np.searchsorted(ends, begin + HASH_BYTES, side="right"))
        if last <= first:
            found[first] = _long_sum(symbols, begin, int(ends[first]))
            last = first + 1
        else:
            found[first:last] = _sums(symbols[begin:int(ends[last - 1])], starts[first:last] - begin,
                                      ends[first:last] - begin)
        first = last
    return mix(found + mix((ends - starts).astype(np.uint64)))


def _sums(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    terms = (symbols.astype(np.uint64) + np.uint64(1)) * _power(len(symbols), _BASE)
    sums = np.empty(len(symbols) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(terms, out=sums[1:])
    return (sums[ends] - sums[starts]) * _power(len(symbols) + 1, _INVERSE)[starts]


def _long_sum(symbols: np.ndarray, start: int, end: int) -> np.uint64:
    """The polynomial of one span that is longer than a block."""
    total = 0
    for a in range(start, end, HASH_BYTES):
        part = symbols[a:min(a + HASH_BYTES, end)]
        whole = _sums(part, np.zeros(1, np.int64), np.full(1, len(part)))
        total += int(whole[0]) * pow(_BASE, a - start, 1 << 64)
    return np.uint64(total & ((1 << 64) - 1))
