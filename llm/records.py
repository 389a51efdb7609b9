"""Token ids as length-delimited binary records, and the index by which they are read in any order.

A file is a run of records. A record is, all little-endian:

    length of the payload          8 bytes
    masked CRC-32 of those 8       4 bytes
    payload                        flag (1 byte: 1, or 0 where doc_id is null), width (1 byte: 2 or 4),
                                   doc_id (8 bytes), ids (width bytes each: 2 where the vocabulary has up to 65,536)
    masked CRC-32 of the payload   4 bytes
    newline                        1 byte

The mask is (crc rotated right by 15) + 0xA282EAD8 modulo 2^32, so that checksums of data which hold checksums stay
strong. Spark's text writer puts the bytes and the newline out, through the commit protocol, to any store that Spark
reaches: a task that is lost and run again leaves no half file. File names ascend as the doc_ids do.

Beside the data an index table (Parquet) holds for each record its file, byte offset, length, doc_id, count of ids and
the count of all ids before it. A reader that wants records in random order seeks by it.

Cases: a null or empty text is a record of the end id alone. Null doc_ids come first. Rows with equal doc_id are all
written, in the order of a hash of their texts, then of their places. No rows: no records, an empty index. Other columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import new_path, per_batch, table, texts, written
from llm.memo import Remembered
from llm.pretokens import PATTERN, batch_matches, splitter

END_ID = 0
#: Text characters that a file holds at about; the number of files follows the input.
FILE_CHARS = 24 << 20
_HEAD, _DOC = struct.Struct("<QI"), struct.Struct("<BBq")
FRAME = _HEAD.size + _DOC.size + 5


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    """One record, without the newline that the writer adds."""
    payload = _DOC.pack(doc_id is not None, width, doc_id or 0) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def frames(data: bytes):
    """(offset, length, doc_id, ids) of each record; ids are an array of 32-bit numbers. ValueError where a length or a checksum is wrong."""
    view, at = memoryview(data), 0
    while at < len(data):
        length, check = _HEAD.unpack_from(data, at)
        if masked(view[at : at + 8]) != check:
            raise ValueError(f"record at byte {at}: the length is damaged")
        body = at + _HEAD.size
        payload = view[body : body + length]
        if len(payload) < length or struct.unpack_from("<I", data, body + length)[0] != masked(payload) or view[body + length + 4 : body + length + 5] != b"\n":
            raise ValueError(f"record at byte {at}: the payload is damaged")
        there, width, doc_id = _DOC.unpack_from(payload)
        yield at, FRAME + len(payload) - _DOC.size, doc_id if there else None, np.frombuffer(payload[_DOC.size :], f"<u{width}").astype("<u4")
        at = body + length + 5


#: Pre-tokens that a worker remembers: twice that at most.
REMEMBERED = 60_000
#: Characters that are cut into pre-tokens together, which bounds what a worker holds beside its batch.
GROUP_CHARS = 1 << 19


def encoder(path: str, pattern: str):
    """The width of an id in bytes, and a function from texts to each one's ids as little-endian bytes with the end id.

    Special tokens' strings in a text are ordinary text. The pattern is the tokenizer's own; its matches are encoded
    apart from each other, so each distinct match goes through the library once as long as the worker remembers it.
    Texts are cut together, GROUP_CHARS characters at a time or one longer text.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part; threads would only cost memory
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    split = splitter(pattern)
    width, kind = (2, "H") if tokenizer.get_vocab_size() <= 1 << 16 else (4, "I")

    def encode(new: list[str]) -> list[bytes]:
        return [array(kind, x.ids).tobytes() for x in tokenizer.encode_batch_fast(new, add_special_tokens=False)]

    known, end = Remembered(encode, REMEMBERED), END_ID.to_bytes(width, "little")
    if pattern != PATTERN:
        return width, lambda texts: [b"".join(known.all(split(text))) + end for text in texts]

    def whole(texts: list[str]) -> list[bytes]:
        """Each distinct match of all texts is looked up once; ids are gathered by number."""
        found, bounds = batch_matches(texts)
        ids = known.all(found.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // width
        begin = np.cumsum(sizes) - sizes
        flat, which = np.frombuffer(b"".join(ids), f"<u{width}"), np.asarray(found.indices)
        many = sizes[which]
        ends = np.cumsum(many)
        out = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[which] - (ends - many), many)]
        cuts = np.concatenate(([0], ends))[bounds]
        return [out[a:b].tobytes() + end for a, b in zip(cuts, cuts[1:], strict=False)]

    def grouped(texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        group: list[str] = []
        size = 0
        for text in texts:
            if group and size + len(text) > GROUP_CHARS:
                out += whole(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        return out + whole(group) if group else out

    return width, grouped


_ENCODERS: dict[str, object] = {}


def write(docs: DataFrame, path: str, vocabulary: str, pattern: str) -> None:
    """Writes docs' records in ascending doc_id order to path/data and their index to path/index."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("hash", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    chars = docs.agg(F.coalesce(F.sum(F.length("text") + 64), F.lit(0))).first()[0]

    def encode():
        width, all_ids = _ENCODERS.get(vocabulary) or _ENCODERS.setdefault(vocabulary, encoder(vocabulary, pattern))  # kept while the worker lives

        def step(batch: pa.RecordBatch) -> dict:
            return {"frame": [frame(d, ids, width) for d, ids in zip(batch.column("doc_id").to_pylist(), all_ids(texts(batch)), strict=True)]}

        return step

    order = ["doc_id", "hash", "place"]  # a doc_id, or a row, that holds a third of all rows fills many files
    ordered = docs.repartitionByRange(max(1, -(-chars // FILE_CHARS)), *order).sortWithinPartitions(*order).select("doc_id", "text")
    per_batch(ordered, encode, "frame binary").select(F.col("frame").cast("string").alias("value")).write.text(f"{path}/data")
    rows = written(scan(spark, path).drop("ids_crc32"), "record-places")
    # a running sum over files: one row of counts a file, rows of documents never meet in one task
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("all"))
    # by number: as texts, part-100000 would come before part-99999
    bases = totals.selectExpr("file", "sum(`all`) over (order by cast(regexp_extract(file, '([0-9]+)', 1) as long)) - `all` as base")
    index = rows.join(bases, "file").select("file", "offset", "length", "doc_id", "n_tokens", (F.col("base") + F.col("before")).alias("start"))
    index.write.parquet(f"{path}/index")


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All records of path/data, checked: file, offset, length, doc_id, n_tokens, before (ids before it in its file), ids_crc32."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data").select("path", "content")

    def read():
        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {k: [] for k in ("file", "offset", "length", "doc_id", "n_tokens", "before", "ids_crc32")}
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                before = 0
                for offset, length, doc_id, ids in frames(data):
                    for k, v in zip(out, (name.rsplit("/", 1)[-1], offset, length, doc_id, len(ids), before, zlib.crc32(ids)), strict=True):
                        out[k].append(v)
                    before += len(ids)
            return out

        return step

    return per_batch(files, read, "file string, offset long, length long, doc_id long, n_tokens long, before long, ids_crc32 long")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def placed(spark: SparkSession, path: str) -> DataFrame:
    """All records as read back from the files, with their start from the index."""
    return scan(spark, path).join(read_index(spark, path).select("file", "offset", "start"), ["file", "offset"])


def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's record as read back from the files and placed by the index."""
    import public_tokenizers

    path = new_path(spark, "records")
    write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return placed(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length")
