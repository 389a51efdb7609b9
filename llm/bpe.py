"""Byte-level BPE as a reduction of a monoid, and its inverse.

An element is the encoding of a byte string: its token ids. Two neighbours are joined without encoding both anew: a
window of tokens around the boundary is re-encoded and grows, on the side that does not fit, until the tokens outside
it provably stand. The proof is by pairs. Call two ids fitting if encoding the bytes of both gives these two ids. Merges
go by rank, and whether two neighbours ever merge across their border depends on the merges inside those two alone. So
a sequence in which each neighbouring pair fits is the encoding of its bytes, and the pairs outside the window did fit
before. Only the two pairs at the window's edges need a test. A window may grow to everything, so the join always ends.

A text is cut by the tokenizer's pattern first; each match is a tree of its own: halves are encoded recursively and
joined. A single match may be megabytes long: the tree is log(n) deep and no step scans it whole but the joins near the
root copy it.

Cases: null counts as empty, and an empty text has no ids; its two digests are those of zero bytes. Equal rows give
equal rows. No rows: no rows. Only doc_id and text are read, so other columns can't clash.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterable, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import per_batch, table, texts
from llm.memo import Remembered
from llm.pretokens import splitter

#: Byte strings up to this length are leaves of the tree.
LEAF = 12
#: Above this length a window is merged through a heap.
SHORT = 64
#: What a worker remembers at most: matches of the pattern (twice that), leaves and pairs.
MATCHES, LEAVES, PAIRS = 100_000, 60_000, 100_000

#: Above any rank.
_NONE = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.digits_of = {i: str(i) for i in self.bytes_of}
        self.split = splitter(pattern)
        self._fits: dict[tuple[int, int], bool] = {}
        self._leaves: dict[bytes, list[int]] = {}
        self._matches = Remembered(lambda new: [array("i", self.encode_bytes(x.encode())).tobytes() for x in new], MATCHES)

    def merge(self, data: bytes) -> list[int]:
        """Merges the neighbours of lowest rank, the leftmost first, until none has a rank."""
        if len(data) <= LEAF:
            found = self._leaves.get(data)
            if found is None:
                if len(self._leaves) >= LEAVES:
                    self._leaves.clear()
                found = self._leaves[data] = self._merge_short(data)
            return found
        return self._merge_short(data) if len(data) <= SHORT else self._merge_long(data)

    def _merge_short(self, data: bytes) -> list[int]:
        rank, parts = self.ranks.get, [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2], _NONE) for i in range(len(data) - 1)]  # of each part and the next one
        while pairs and (best := min(pairs)) < _NONE:
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], _NONE)
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], _NONE)
        return [self.ranks[p] for p in parts]

    def _merge_long(self, data: bytes) -> list[int]:
        ranks, n = self.ranks, len(data)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins at i; -1 once it is gone
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, to = heapq.heappop(heap)
            middle = end[i]
            if middle < 0 or middle >= n or end[middle] != to:  # one of the two has been merged since
                continue
            end[i], end[middle] = to, -1
            if to < n:
                before[to] = i
                if (r := ranks.get(data[i : end[to]])) is not None:
                    heapq.heappush(heap, (r, i, end[to]))
            if (p := before[i]) >= 0 and (r := ranks.get(data[p:to])) is not None:
                heapq.heappush(heap, (r, p, to))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return out

    def fits(self, a: int, b: int) -> bool:
        found = self._fits.get((a, b))
        if found is None:
            if len(self._fits) >= PAIRS:
                self._fits.clear()
            found = self._fits[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The monoid's operation: the encoding of the bytes of left and right together."""
        if not left or not right:
            return left or right
        if self.fits(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            inner = self.merge(b"".join(map(self.bytes_of.__getitem__, left[-i:] + right[:j])))
            fits_left = i == len(left) or self.fits(left[-i - 1], inner[0])
            fits_right = j == len(right) or self.fits(inner[-1], right[j])
            if fits_left and fits_right:
                return left[:-i] + inner + right[j:]
            if not fits_left:
                i = min(2 * i, len(left))
            if not fits_right:
                j = min(2 * j, len(right))

    def encode_bytes(self, data: bytes) -> list[int]:
        """Halves, recursively; a byte string that is a token is that token."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        if len(data) <= LEAF:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.encode_bytes(data[:half]), self.encode_bytes(data[half:]))

    def encode(self, text: str) -> array:
        return array("i", b"".join(self._matches.all(self.split(text))))

    def decode(self, ids: Sequence[int]) -> bytes:
        """Concatenates up the same kind of tree."""
        if len(ids) <= 1 << 12:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    def digits(self, ids: Iterable[int]) -> str:
        return ",".join(map(self.digits_of.__getitem__, ids))


_LOADED: dict[tuple[str, str], Bpe] = {}


def loaded(path: str, pattern: str) -> Bpe:
    """One a worker, kept while it lives; what it remembers is bounded."""
    return _LOADED.get((path, pattern)) or _LOADED.setdefault((path, pattern), Bpe(read_ranks(path), pattern))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids: the ids of each whole text."""

    def make():
        bpe = loaded(path, pattern)

        def step(batch: pa.RecordBatch) -> dict:
            ids = [np.frombuffer(bpe.encode(t), np.int32) for t in texts(batch)]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            return {"doc_id": batch.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))}

        return step

    return per_batch(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, data: the bytes that the ids stand for; null ids count as none."""

    def make():
        bpe = loaded(path, pattern)
        return lambda batch: {"doc_id": batch.column("doc_id"), "data": [bpe.decode(x or []) for x in batch.column("ids").to_pylist()]}

    return per_batch(encoded.select(F.col("doc_id").cast("long"), "ids"), make, "doc_id long, data binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of what they decode to, in one pass over the texts."""

    def make():
        bpe = loaded(path, pattern)

        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"doc_id": batch.column("doc_id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in texts(batch):
                ids = bpe.encode(text)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(bpe.digits(ids).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            return out

        return step

    return per_batch(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
