"""Sums of doubles that depend neither on the order nor on the grouping of their terms.

A finite double is an integer multiple of a power of two, so sums are kept as integers: exact within a task, cut
into 32-bit limbs for the exchange (Spark adds limbs as integers, in any order), and rounded once at the end.
However the rows are spread over tasks, and whichever task comes first, the result has the same bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SCALE = 2400  # sums are integers in units of 2 ** -SCALE: below every product of two doubles
LIMB = 32
BLOCK = 4096  # rows whose products are summed as integer-valued doubles


def _finite(values: np.ndarray) -> None:
    if not np.isfinite(values).all():
        raise ValueError("an exact sum needs finite numbers")


def totals(values: np.ndarray) -> list[int]:
    """The exact sum of each column of a matrix, in units of ``2 ** -SCALE``."""
    _finite(values)
    rows, columns = values.shape
    found = [0] * columns
    if not rows:
        return found
    fraction, exponent = np.frexp(values)
    whole = (fraction * (1 << 53)).astype(np.int64)
    low = int(exponent.min())
    width = int(exponent.max()) - low + 1
    key = ((exponent - low) + width * np.arange(columns)).ravel()
    # halves of 27 bits: their sums per exponent are exact for up to 2 ** 26 rows
    upper, lower = (whole >> 27).ravel(), (whole & ((1 << 27) - 1)).ravel()
    highs, lows = (np.bincount(key, weights=h, minlength=width * columns) for h in (upper, lower))
    for cell in np.flatnonzero((highs != 0) | (lows != 0)).tolist():
        column, place = divmod(cell, width)
        found[column] += ((int(highs[cell]) << 27) + int(lows[cell])) << (place + low - 53 + SCALE)
    return found


def _slices(block: np.ndarray, bits: int) -> tuple[np.ndarray, list[int], list[int]]:
    """The block as a sum of integer columns times powers of two: (integers, column of each, exponent of each)."""
    rest, parts, of, powers = block.copy(), [], [], []
    while True:
        left = np.flatnonzero(np.abs(rest).max(axis=0, initial=0.0) > 0)
        if not len(left):
            break
        for c in left.tolist():
            power = int(np.frexp(np.abs(rest[:, c]).max())[1]) - bits
            whole = np.trunc(np.ldexp(rest[:, c], -power))
            rest[:, c] -= np.ldexp(whole, power)  # exact: the leading bits go
            parts.append(whole)
            of.append(c)
            powers.append(power)
    return (np.column_stack(parts) if parts else np.zeros((len(block), 0))), of, powers


def products(matrix: np.ndarray) -> dict[tuple[int, int], int]:
    """The exact ``matrix' matrix``, upper half, in units of ``2 ** -SCALE``.

    Columns are cut into slices of so few bits that the products of a block, as doubles, add up without
    rounding; the multiplication itself is the library's, since exact results have no order.
    """
    _finite(matrix)
    found: dict[tuple[int, int], int] = {}
    for a in range(0, len(matrix), BLOCK):
        block = matrix[a:a + BLOCK]
        whole, of, powers = _slices(block, (52 - max(len(block) - 1, 1).bit_length()) // 2)
        sums = (whole.T @ whole).astype(np.int64).tolist()
        for x, (i, p) in enumerate(zip(of, powers, strict=True)):
            for y, (j, q) in enumerate(zip(of, powers, strict=True)):
                if i <= j and sums[x][y]:
                    found[i, j] = found.get((i, j), 0) + (sums[x][y] << (p + q + SCALE))
    return found


def limbs(total: int) -> Iterator[tuple[int, int]]:
    """(place, signed 32-bit digit) of a sum; digits of one place may be added in any order."""
    sign, rest, place = (-1 if total < 0 else 1), abs(total), 0
    while rest:
        digit = rest & ((1 << LIMB) - 1)
        if digit:
            yield place, sign * digit
        rest >>= LIMB
        place += 1


def joined(digits: Iterable[tuple[int, int]]) -> int:
    """The sum that added digits stand for."""
    return sum(digit << (LIMB * place) for place, digit in digits)


def rounded(total: int, divisor: int = 1) -> float:
    """``total / divisor`` as the nearest double."""
    return total / (divisor << SCALE)
