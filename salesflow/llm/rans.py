"""A static range asymmetric numeral system over blocks of token ids.

One frequency table is shared by all blocks. A block is independent: its ids are dealt over
interleaved lanes, a step encodes one id in every lane, and each lane has a 64-bit state that gives off
32-bit words. Checkpoints keep all states and the place in the words every ``every`` steps, so a
block can be decoded from several places at once; a CRC-32 of the ids closes it.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

MAGIC = b"RANS"
HEADER = struct.Struct("<4sHHIIIII")  # magic, version, scale bits, ids, lanes, every, words, crc
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)


@dataclass(frozen=True)
class Table:
    """Frequencies that sum up to 2 ** bits, their running sum, and the id of every slot."""

    freq: np.ndarray
    cum: np.ndarray
    slots: np.ndarray
    bits: int

    @classmethod
    def of(cls, freq: np.ndarray) -> Table:
        freq = freq.astype(np.uint64)
        total = int(freq.sum())
        if total & (total - 1) or not total:
            raise ValueError("frequencies must sum up to a power of two")
        cum = np.cumsum(freq) - freq
        slots = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        return cls(freq, cum, slots, total.bit_length() - 1)


def scaled(counts: np.ndarray, bits: int = 20) -> np.ndarray:
    """Frequencies for ``counts``: at least 1 for every id that occurs, 2 ** bits in all."""
    counts = counts.astype(np.float64)
    used = counts > 0
    if used.sum() > 1 << bits or not used.any():
        raise ValueError("the table needs between one id and as many as it has slots")
    freq = np.where(used, np.maximum(1, np.floor(counts / counts.sum() * (1 << bits))), 0).astype(np.int64)
    order = np.argsort(-freq, kind="stable")
    spare = (1 << bits) - int(freq.sum())
    if spare > 0:
        freq[order[0]] += spare
    for i in order:  # the largest give back what the least were raised by
        if spare >= 0:
            break
        given = min(int(freq[i]) - 1, -spare)
        freq[i] -= given
        spare += given
    return freq


def encode(ids: np.ndarray, table: Table, most_lanes: int = 4096, every: int = 128) -> bytes:
    """One block."""
    n = len(ids)
    lanes = int(np.clip(n >> 6, 1, most_lanes))
    steps = -(-n // lanes)
    bits, shift = np.uint64(table.bits), np.uint64(63 - table.bits)
    states = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    points: list[tuple[int, np.ndarray]] = []
    sent = 0
    for t in range(steps - 1, -1, -1):
        part = ids[t * lanes:(t + 1) * lanes]
        x, f = states[:len(part)], table.freq[part]
        full = x >= (f << shift)
        out = x[full]
        words.append(out.astype(np.uint32))
        sent += len(out)
        x = np.where(full, x >> WORD, x)
        q = x // f
        states[:len(part)] = (q << bits) + (x - q * f) + table.cum[part]
        if t and t % every == 0:
            points.append((sent, states.copy()))
    head = HEADER.pack(MAGIC, 1, table.bits, n, lanes, every, sent,
                       zlib.crc32(ids.astype("<u4").tobytes()))
    marks = b"".join(struct.pack("<I", sent - at) + x.astype("<u8").tobytes() for at, x in reversed(points))
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    return head + states.astype("<u8").tobytes() + marks + stream.astype("<u4").tobytes()


def _opened(block: bytes) -> tuple:
    magic, version, bits, n, lanes, every, sent, crc = HEADER.unpack_from(block)
    if magic != MAGIC or version != 1:
        raise ValueError("not a block of this format")
    steps = -(-n // lanes)
    count = max(0, -(-steps // every) - 1)
    at = HEADER.size + 8 * lanes
    size = 4 + 8 * lanes
    words = np.frombuffer(block, "<u4", sent, at + count * size)
    return bits, n, lanes, every, steps, crc, at, size, words


def decode(block: bytes, table: Table) -> np.ndarray:
    """All ids of a block; a wrong checksum is an error."""
    n, crc = _opened(block)[1], _opened(block)[5]
    ids = decode_steps(block, table, 0, None)
    if len(ids) != n or zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("checksum of a block does not match")
    return ids


def checkpoints(block: bytes) -> int:
    """The number of places at which decoding can begin."""
    _, n, _, every, steps, *_ = _opened(block)
    return max(1, -(-steps // every))


def decode_part(block: bytes, table: Table, point: int) -> np.ndarray:
    """The ids from one checkpoint to the next (0: the block's beginning)."""
    every = _opened(block)[3]
    return decode_steps(block, table, point * every, (point + 1) * every)


def decode_steps(block: bytes, table: Table, first: int, last: int | None) -> np.ndarray:
    """The ids of the steps ``first`` (a multiple of ``every``) up to ``last``."""
    bits_, n, lanes, every, steps, _, at, size, words = _opened(block)
    if bits_ != table.bits:
        raise ValueError("the block was written with another table")
    last = steps if last is None else min(last, steps)
    if first:
        mark = at + (first // every - 1) * size
        (place,) = struct.unpack_from("<I", block, mark)
        states = np.frombuffer(block, "<u8", lanes, mark + 4).astype(np.uint64)
    else:
        place, states = 0, np.frombuffer(block, "<u8", lanes, HEADER.size).astype(np.uint64)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    out = np.empty(min(n, last * lanes) - first * lanes, np.uint32)
    for t in range(first, last):
        width = min(lanes, n - t * lanes)
        x = states[:width]
        slot = x & mask
        ids = table.slots[slot]
        out[(t - first) * lanes:(t - first) * lanes + width] = ids
        x = table.freq[ids] * (x >> bits) + slot - table.cum[ids]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << WORD) | words[place:place + len(low)]
        place += len(low)
        states[:width] = x
    return out
