"""Hashed character n-grams of many texts at once, and the sums of weights over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from salesflow.llm.textscan import padded, pieces

PIECE = 1 << 20  # bytes of text that are scanned at once

_LETTERS = np.full(256, 0x20, np.uint8)  # ASCII letters lower-cased, other ASCII: blank
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def hashed(symbols: np.ndarray, n: int) -> np.ndarray:
    """A 32-bit hash of the ``n`` bytes from each position (the last n - 1 have none)."""
    count = max(len(symbols) - n + 1, 0)
    value = np.full(count, n, np.uint32)
    for k in range(n):
        value *= np.uint32(0x01000193)
        value ^= symbols[k:k + count]
    value ^= value >> np.uint32(15)
    value *= np.uint32(0x2C1B3C6D)
    value ^= value >> np.uint32(13)
    return value


def grams(texts: pa.Array, sizes: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of texts, text of each n-gram, hash of each n-gram), piece by piece.

    An n-gram lies within one word and the blanks around it. A text longer than a piece comes in
    several blocks of the same piece: the text numbers of a block are relative to ``first``.
    """
    for first, part in pieces(texts, PIECE):
        data, borders = padded(part)
        symbols = _LETTERS[data]
        for begin in range(0, len(symbols), PIECE):
            block = symbols[begin:begin + PIECE + max(sizes) - 1]
            solid = block != 0x20
            cuts = np.searchsorted(borders, np.arange(begin, begin + 1), side="right") - 1
            inner = borders[(borders > begin) & (borders < begin + len(block))] - begin
            owner = np.zeros(len(block), np.int32)
            owner[inner] = 1
            owner = np.cumsum(owner, dtype=np.int32) + np.int32(first + cuts[0])
            for n in sizes:
                count = min(len(block) - n + 1, PIECE)
                if count <= 0:
                    continue
                good = solid[1:1 + count] if n > 2 else solid[:count] | solid[1:1 + count]
                for k in range(2, n - 1):
                    good = good & solid[k:k + count]
                at = np.flatnonzero(good)
                yield first, owner[at], hashed(block, n)[at]
