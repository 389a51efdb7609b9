"""Document fingerprints by one-permutation MinHash.

Each five-word shingle is hashed once: the first bits of the hash name one of BINS bins, the rest is its value there, and each bin
keeps its least value. An empty bin takes the value of another: bin i asks the bins in an order of its own, which is the same for
all documents, and takes that of the first that isn't empty (optimal densification: each non-empty bin is equally likely, and
independently for each empty one). Of each value, mixed with its bin's number, the BITS low-order bits are kept, packed, in hex.

Two values that differ agree in BITS bits with a chance of 2^-BITS. So if a share p of the bins agrees, the estimate of the sets' Jaccard
similarity is (p - 2^-BITS) / (1 - 2^-BITS), or 0 below that. Its standard deviation is at most 0.024.

Cases: a null text is empty. Texts of fewer than five words, but not none, are one shingle. A text without words has the fingerprint ''
(no bin can be filled); two of them are alike by 1, one and another text by 0. Repeated rows have equal fingerprints, and no rows give none.
Words are those of `llm.words`.

`edited` needs each document's next one. Documents are sorted by doc_id (nulls first), those that share it by a hash of the text and
then by their place in the table, so one doc_id with any share of the rows is dealt to many tasks. Each text is shuffled once; a task meets
its documents in order and holds two of them at a time besides its batch; the last of a task meets the first of the next
one afterwards, one row a task. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import per_batch, table, texts, written
from llm.words import hashed_words, mix, shingles

SIZE, BINS, BITS = 5, 512, 4
_EMPTY = np.uint64(2**64 - 1)
_CHANCE = 2.0**-BITS


@lru_cache(maxsize=2)
def _orders(bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """For each bin the order in which it asks the others, and the place of each other bin in that order."""
    drawn = mix(np.arange(1, bins * bins + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(bins, bins)
    order = np.argsort(drawn, axis=1, kind="stable")
    return order, np.argsort(order, axis=1, kind="stable").astype(np.int32)


def _least(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The least value of each bin of each text; _EMPTY where there is none."""
    out = np.full((len(bounds) - 1, BINS), _EMPTY)
    shift = np.uint64(64 - (BINS - 1).bit_length())
    step = 1 << 20
    for at in range(0, len(hashes), step):  # a block of shingles, so that memory is bounded
        own = hashes[at : at + step]
        row = np.searchsorted(bounds, np.arange(at, at + len(own)), "right") - 1
        place = row * BINS + (own >> shift).astype(np.int64)
        order = np.argsort(place, kind="stable")
        place, value = place[order], (own & np.uint64((1 << int(shift)) - 1))[order]
        begin = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        flat = out.reshape(-1)
        flat[place[begin]] = np.minimum(flat[place[begin]], np.minimum.reduceat(value, begin))
    return out


def _dense(least: np.ndarray) -> np.ndarray:
    """least with the empty bins filled; each row must have a bin that isn't."""
    order, place = _orders()
    filled = least != _EMPTY
    have = filled.sum(axis=1)
    out = least.copy()
    # few bins: the nearest in each bin's order among them; many: ask one after another
    for i in np.flatnonzero((have > 0) & (have * have <= BINS)):
        own = np.flatnonzero(filled[i])
        out[i] = np.where(filled[i], least[i], least[i, own[place[:, own].argmin(axis=1)]])
    row, bin_ = np.nonzero(~filled & (have * have > BINS)[:, None])
    for asked in range(BINS):
        if not len(row):
            break
        source = order[bin_, asked]
        found = filled[row, source]
        out[row[found], bin_[found]] = least[row[found], source[found]]
        row, bin_ = row[~found], bin_[~found]
    return out


def packed(column: pa.Array) -> np.ndarray:
    """The packed bits of each text of a column, one row each, all zero where a text has no words; and which texts have some."""
    hashes, bounds = shingles(*hashed_words(column), SIZE)
    some = np.diff(bounds) > 0
    dense = _dense(_least(hashes, bounds))
    low = (mix(dense + mix(np.arange(BINS, dtype=np.uint64))[None, :]) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    bits = (low[:, :, None] >> np.arange(BITS - 1, -1, -1, dtype=np.uint8)) & 1
    out = np.packbits(bits.reshape(len(low), BINS * BITS), axis=1)
    out[~some] = 0
    return out, some


def likeness(one: np.ndarray, other: np.ndarray, some: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The estimate for each row of two arrays of packed bits; some, others: which rows are of texts with words."""
    differ = np.unpackbits(one ^ other, axis=1).reshape(len(one), BINS, BITS).any(axis=2)
    share = 1 - differ.mean(axis=1)
    found = np.clip((share - _CHANCE) / (1 - _CHANCE), 0, 1)
    return np.where(some & others, found, np.where(some | others, 0.0, 1.0))


def _hex(bits: np.ndarray, some: np.ndarray) -> list[str]:
    return [row.tobytes().hex() if s else "" for row, s in zip(bits, some, strict=True)]


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs with the column `fingerprint` of their text; a column of that name is replaced."""
    others = docs.drop("fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_hex(*packed(batch.column("text").cast(pa.string()))), pa.string())], names=[*batch.schema.names, "fingerprint"])

    from pyspark.sql.types import StringType, StructType

    return others.mapInArrow(run, StructType([*others.schema.fields]).add("fingerprint", StringType()))


def near(pairs: DataFrame, one: str, other: str, into: str) -> DataFrame:
    """pairs with the likeness of two columns of fingerprints; null where one is null. Built-in expressions alone."""

    def nibbles(name: str):  # BITS is one hex digit
        return F.split(F.col(name), "(?<=.)(?=.)")

    same = F.aggregate(F.zip_with(nibbles(one), nibbles(other), lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    found = F.greatest(F.lit(0.0), (same / F.lit(BINS) - _CHANCE) / (1 - _CHANCE))
    both = F.when((F.col(one) == "") | (F.col(other) == ""), (F.col(one) == F.col(other)).cast("double")).otherwise(found)
    return pairs.withColumn(into, F.when(F.col(one).isNotNull() & F.col(other).isNotNull(), both))


def edit(text: str, following: str) -> str:
    """text whose last half (code points, rounded down) is replaced by as many first ones of the following text, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.binary(),
    "bits": pa.binary(),
    "edited_bits": pa.binary(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
}
_EDGE = {"task": pa.int64(), "first": pa.string(), "last": pa.string()}
_SQL = "doc_id long, n_chars long, edited_sha256 binary, bits binary, edited_bits binary, near_edited double, near_next double"


def _results(ids: list, own: list[str], bits: np.ndarray, some: np.ndarray) -> list[pa.Array]:
    """The results of all texts of own but the last; each has its next one behind it. bits, some: of all."""
    n = len(own) - 1
    edited = [edit(own[i], own[i + 1]) for i in range(n)]
    changed, with_words = packed(pa.array(edited, pa.string()))
    columns = (
        ids[:n],
        [len(t) for t in own[:n]],
        [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in edited],
        [b.tobytes() if s else b"" for b, s in zip(bits[:n], some[:n], strict=True)],
        [b.tobytes() if s else b"" for b, s in zip(changed, with_words, strict=True)],
        likeness(bits[:n], changed, some[:n], with_words),
        likeness(bits[:n], bits[1:], some[:n], some[1:]),
    )
    return [pa.array(c, t) for c, t in zip(columns, _RESULT.values(), strict=True)]


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in order: results of all but the task's last one, then one row of its first text and its last document."""
    from pyspark import TaskContext

    carried: tuple | None = None
    first = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own, ids = texts(batch), batch.column("doc_id").to_pylist()
        first = own[0] if first is None else first
        bits, some = packed(batch.column("text"))
        if carried:
            ids, own = [carried[0], *ids], [carried[1], *own]
            bits, some = np.concatenate((carried[2], bits)), np.concatenate((carried[3], some))
        carried = (ids[-1], own[-1], bits[-1:].copy(), some[-1:].copy())
        if len(own) > 1:
            found = _results(ids, own, bits, some)
            yield pa.RecordBatch.from_arrays([*found, *(pa.nulls(len(own) - 1, t) for t in _EDGE.values())], names=[*_RESULT, *_EDGE])
    if carried:
        line = [pa.array([carried[0]], pa.int64()), *(pa.nulls(1, t) for t in list(_RESULT.values())[1:])]
        edge = [pa.array([v], t) for v, t in zip((TaskContext.get().partitionId(), first, carried[1]), _EDGE.values(), strict=True)]
        yield pa.RecordBatch.from_arrays([*line, *edge], names=[*_RESULT, *_EDGE])


def _across():
    def step(batch: pa.RecordBatch) -> dict:
        parts = []
        for doc_id, last, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "last", "following")), strict=True):
            parts.append(_results([doc_id], [last, following], *packed(pa.array([last, following], pa.string()))))
        return {c: pa.concat_arrays([p[i] for p in parts]) for i, c in enumerate(_RESULT)}

    return step


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row of docs.

    The edited text is :func:`edit` of a document and the next one in order; the first one follows the last.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    order = ["doc_id", "hash", "place"]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    found = written(sorted_.mapInArrow(_along, f"{_SQL}, task long, first string, last string"), "along")
    edges = found.filter("task is not null")
    tasks = [r.task for r in edges.select("task").orderBy("task").collect()]  # one number for each task with rows
    after = docs.sparkSession.createDataFrame(list(zip(tasks, [*tasks[1:], *tasks[:1]], strict=True)), "task long, next long")
    firsts = edges.select(F.col("task").alias("next"), F.col("first").alias("following"))
    across = per_batch(edges.select("task", "doc_id", "last").join(after, "task").join(firsts, "next").select("doc_id", "last", "following"), _across, _SQL)
    every = found.filter("task is null").select(*_RESULT).unionByName(across)
    return every.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        F.lower(F.hex("bits")).alias("fingerprint"),
        F.lower(F.hex("edited_bits")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited(table(spark, sf_dir, "documents"))
