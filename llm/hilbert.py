"""Positions of vectors along a Hilbert curve, by vector operations over all rows of a batch."""

from __future__ import annotations

import numpy as np

#: Bits of a cell in each dimension.
BITS = 4


def cells(rows: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The cell of each row's direction: components in units of the row's root mean square, from -2 to 2 in equal steps."""
    size = np.sqrt((rows * rows).mean(axis=1, keepdims=True)) if rows.shape[1] else np.ones((len(rows), 1))
    place = (rows / np.where(size > 0, size, 1) + 2) / 4 * (1 << bits)
    return np.clip(place, 0, (1 << bits) - 1).astype(np.uint32)


def keys(cell: np.ndarray, bits: int = BITS) -> list[bytes]:
    """Bytes that sort as the rows' cells follow each other on the curve.

    The curve enters each cube's corners in the order of a Gray code, turned so that neighbours touch: from the coarsest bit
    to the finest, a set bit turns the finer bits of the first dimension over, an unset one swaps them with that dimension's.
    """
    x = cell.T.copy()
    if not len(x):
        return [b""] * len(cell)
    for bit in range(bits - 1, 0, -1):
        finer = np.uint32((1 << bit) - 1)
        for row in x:
            set_ = (row >> np.uint32(bit)) & np.uint32(1) == 1
            swap = np.where(set_, np.uint32(0), (x[0] ^ row) & finer)
            x[0] ^= np.where(set_, finer, swap)
            row ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    turned = np.zeros(x.shape[1], np.uint32)
    for bit in range(bits - 1, 0, -1):
        turned ^= np.where((x[-1] >> np.uint32(bit)) & np.uint32(1) == 1, np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= turned
    planes = np.stack([(x >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1)])  # bit, dimension, row
    packed = np.packbits(planes.reshape(-1, x.shape[1]).astype(np.uint8), axis=0)
    return [column.tobytes() for column in packed.T]
