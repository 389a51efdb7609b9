"""Words of whole texts as numbers, by vector operations over the bytes of a whole Arrow batch.

A word is a longest run of ASCII letters and digits and of any character beyond ASCII; A-Z count as a-z. In UTF-8 that
is a matter of single bytes: every byte from 0x80 on belongs to a word.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256)
#: a-z for A-Z, a space for what parts words, every other byte itself.
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
LOWER[[b for b in range(128) if not chr(b).isalnum()]] = 32
LOWER_BYTES = LOWER.tobytes()


def word_list(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split()


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit of the result depends on every bit of x."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column, one space after each, and where each text begins (one more entry than texts)."""
    parts = [b"" if x is None else x.encode("utf-8", "surrogatepass") for x in column.to_pylist()]
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=starts[1:])
    return np.frombuffer(b" ".join(parts) + b" ", np.uint8), starts


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and where each text's words begin (one more entry than texts)."""
    if len(column) == 0:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    raw, starts = column_bytes(column)
    low = LOWER[raw]
    inside = low != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    hashes = np.zeros(len(begin), np.uint64)
    step = 1 << 19  # a block of bytes, so that the powers stay in the cache and memory is bounded
    power, inverse = _powers(_BASE, step + 1), _powers(_INVERSE, step + 1)
    at = 0
    while at < len(begin):
        first = begin[at]
        to = int(np.searchsorted(end, first + step, "right"))
        if to == at:  # one word longer than a block
            code = _BYTE_CODE[low[begin[at] : end[at]]]
            total = 0
            for k in range(0, len(code), step):
                piece = code[k : k + step]
                total = (total * int(power[len(piece) - 1]) * _BASE + int(np.sum(piece * power[: len(piece)], dtype=np.uint64))) & ((1 << 64) - 1)
            hashes[at] = total
            at += 1
            continue
        last = end[to - 1]
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(_BYTE_CODE[low[first:last]] * power[: last - first], out=sums[1:])
        hashes[at:to] = (sums[end[at:to] - first] - sums[begin[at:to] - first]) * inverse[begin[at:to] - first]
        at = to
    bounds = np.searchsorted(begin, starts)
    return mix(hashes + (end - begin).astype(np.uint64)), bounds


def shingles(words: np.ndarray, bounds: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of `size` words, in order; a text of fewer words, but not none, has one run of them all."""
    counts = np.diff(bounds)
    full = np.maximum(counts - size + 1, 0)
    short = (counts > 0) & (counts < size)
    n = full + short
    out_bounds = np.concatenate(([0], np.cumsum(n)))
    out = np.zeros(out_bounds[-1], np.uint64)
    if len(words) >= size:
        runs = np.zeros(len(words) - size + 1, np.uint64)
        for k in range(size):
            runs += mix(words[k : len(words) - size + 1 + k] + np.uint64(k + 1))
        place = np.repeat(bounds[:-1] - out_bounds[:-1], full + 0 * n) if not short.any() else None
        if place is not None:
            out = runs[np.arange(len(out)) + place]
        else:
            for i in np.flatnonzero(full):
                out[out_bounds[i] : out_bounds[i] + full[i]] = runs[bounds[i] : bounds[i] + full[i]]
    for i in np.flatnonzero(short):
        own = words[bounds[i] : bounds[i + 1]]
        out[out_bounds[i]] = np.sum(mix(own + np.arange(1, len(own) + 1, dtype=np.uint64)), dtype=np.uint64) + np.uint64(len(own))
    return mix(out), out_bounds
