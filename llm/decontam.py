"""Benchmark decontamination: an FM-index over each shard of training words, searched for the benchmark's phrases.

A window is WINDOW consecutive words of an item; an item of fewer words, but not none, is one window. A task gathers the
words of its documents into shards. Words that no item holds can't be in a match, so they only part the others; what is
too short between two of them for any window is left out. Each shard's index is searched backwards for all windows at
once, occurrences are located through sampled suffix positions, and overlapping ones are merged into removal spans.

The windows of a block of items travel to every task. A block holds about BLOCK_CHARS characters of items; a larger
benchmark is taken block after block, each over all documents, without a shuffle.

Cases: null and empty texts have no words, in documents and items. Equal items, and rows of one item_id with different
texts, count as one item; a null item_id is the empty string. A benchmark without words leaves all clean. Equal
documents give equal rows. Other columns pass through `clean` as they are, whatever their names.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table
from llm.fmindex import FmIndex
from llm.words import word_list

WINDOW = 10
BLOCK_CHARS = 8 << 20
#: Words that one index holds.
SHARD = 1 << 19
#: `clean` drops a document of which at least this share of words is hit; of others it cuts the spans out.
DROPPED_FROM = 0.5
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")  # over lower-cased text


class Block:
    """Windows of some items: by length an array of word numbers, one window a line, and the items of each."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        found: dict[tuple[int, ...], set[str]] = {}
        self.numbers: dict[bytes, int] = {}
        for item, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 2) for w in word_list(text)]
            for i in range(max(1, len(words) - size + 1) if words else 0):
                found.setdefault(tuple(words[i : i + size]), set()).add(item)
        self.by_length = []
        for length in sorted({len(w) for w in found}):
            own = [w for w in found if len(w) == length]
            self.by_length.append((length, np.array(own, np.int64), [sorted(found[w]) for w in own]))
        self.shortest = self.by_length[0][0] if found else 0
        self.longest = self.by_length[-1][0] if found else 0

    def search(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[set[str]], np.ndarray]:
        """Start and end words of the hits, over the words of all texts in order; each text's items; where texts begin."""
        get, parts, starts = self.numbers.get, [], np.zeros(len(texts) + 1, np.int64)
        for k, text in enumerate(texts):
            words = word_list(text) if text else []
            parts.append(np.fromiter(map(get, words, repeat(1)), np.int64, len(words)))
            starts[k + 1] = starts[k] + len(words)
        items: list[set[str]] = [set() for _ in texts]
        none = np.zeros(0, np.int64)
        if not self.longest or not starts[-1]:
            return none, none, items, starts
        symbols = np.concatenate(parts)
        run = symbols > 1
        begins = np.zeros(len(symbols), bool)
        begins[starts[:-1][starts[:-1] < len(symbols)]] = True
        first = np.flatnonzero(run & (begins | np.concatenate(([True], ~run[:-1]))))
        last = np.flatnonzero(run & np.concatenate((~run[1:] | begins[1:], [True]))) + 1
        long = last - first >= self.shortest
        first, last = first[long], last[long]
        if not len(first):
            return none, none, items, starts
        size = last - first + 1  # and a 1 that parts it from the next
        where = np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        parted = np.cumsum(size) - 1
        symbols = symbols[np.minimum(where, len(symbols) - 1)]
        symbols[parted] = 1
        hits, ends = [none], [none]
        for at in range(0, len(symbols), SHARD - self.longest):
            shard = symbols[at : at + SHARD]
            index = FmIndex(shard, len(self.numbers) + 1)
            for length, windows, of in self.by_length:
                low, high = index.search(windows)
                n = high - low
                if not n.any():
                    continue
                rows = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                start = where[at + index.locate(rows)]
                hits.append(start)
                ends.append(start + length)
                window = np.repeat(np.arange(len(n)), n)
                text = np.searchsorted(starts, start, "right") - 1
                for t, w in zip(*np.divmod(np.unique(text * len(n) + window), len(n)), strict=True):
                    items[t].update(of[w])
        return np.concatenate(hits), np.concatenate(ends), items, starts


def _merged(start: np.ndarray, end: np.ndarray, starts: np.ndarray) -> list[list[int]]:
    """Each text's hits as flat lists of the start and end words of spans that neither overlap nor touch."""
    out: list[list[int]] = [[] for _ in range(len(starts) - 1)]
    if len(start):
        change = np.zeros(starts[-1] + 1, np.int64)
        np.add.at(change, start, 1)
        np.add.at(change, end, -1)
        hit = np.cumsum(change)[:-1] > 0
        begins = np.zeros(len(hit), bool)
        begins[starts[:-1][starts[:-1] < len(hit)]] = True
        first = np.flatnonzero(hit & (begins | np.concatenate(([True], ~hit[:-1]))))
        last = np.flatnonzero(hit & np.concatenate((~hit[1:] | begins[1:], [True]))) + 1
        for t, a, b in zip((np.searchsorted(starts, first, "right") - 1).tolist(), first.tolist(), last.tolist(), strict=True):
            out[t] += (a - int(starts[t]), b - int(starts[t]))
    return out


def find(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """row (all columns of docs but text, as a struct), text, n_words, spans (flat list of start and end words), items."""
    spark = docs.sparkSession
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-chars // BLOCK_CHARS))
    found = docs.selectExpr("row", "text", "0L as n_words", "cast(array() as array<int>) as spans", "cast(array() as array<string>) as items")
    for k in range(n_blocks):
        own = [(r.item, r.text) for r in items.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == k).collect()]
        found = _search_block(found, spark.sparkContext.broadcast(Block(own, size)))
    return found


def _search_block(found: DataFrame, block) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(found.schema)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column("text").to_pylist()
            start, end, items, starts = block.value.search(texts)
            before = batch.column("spans")
            if len(before.flatten()):
                pairs = np.asarray(before.flatten()).reshape(-1, 2) + np.repeat(starts[:-1], np.diff(np.asarray(before.offsets)) // 2)[:, None]
                start, end = np.concatenate((start, pairs[:, 0])), np.concatenate((end, pairs[:, 1]))
            items = [sorted(new.union(old)) for new, old in zip(items, batch.column("items").to_pylist(), strict=True)]
            columns = [batch.column("row"), batch.column("text"), pa.array(np.diff(starts)), pa.array(_merged(start, end, starts), pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return found.mapInArrow(run, found.schema)


def n_hit(spans: str = "spans") -> F.Column:
    """Words in the spans: the ends' sum less the starts'."""
    return F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 1, x.cast("long")).otherwise(-x.cast("long"))), F.lit(0).cast("long"), lambda a, x: a + x)


def cut(text: str, spans: list[int]) -> str:
    """text without the words of the spans and what stands between them."""
    if not spans:
        return text
    places = [(m.start(), m.end()) for m in _WORD.finditer(re.sub("[A-Z]", "a", text))]
    out, at = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return "".join(out) + text[at:]


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """docs without benchmark passages: spans are cut out of the texts, n_chars follows, and documents hit for the most go."""
    found = find(docs, benchmark, size).filter(n_hit() < F.greatest(F.col("n_words") * DROPPED_FROM, F.lit(1)))

    @F.pandas_udf("string")
    def cut_texts(texts, spans):
        return texts.combine(spans, lambda t, s: t if t is None else cut(t, list(s)))

    hit = F.size("spans") > 0
    found = found.withColumn("text", F.when(hit, cut_texts("text", "spans")).otherwise(F.col("text")))
    out = []
    for c, kind in docs.dtypes:
        if c == "text":
            out.append(F.col("text"))
        elif c == "n_chars":
            out.append(F.when(hit, F.length("text").cast(kind)).otherwise(F.col("row.n_chars")).alias(c))
        else:
            out.append(F.col(f"row.`{c}`").alias(c))
    return found.select(*out)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = find(docs.select("doc_id", "text"), benchmark)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


#: The same rows by DuckDB, by looking at each run of ten words for an equal window.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item, array_to_string(w[i:i + 9], ' ') AS phrase, least(10, len(w)) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (SELECT dw.doc_id, dw.i, dw.n, bw.item FROM dw JOIN bw USING (phrase, n)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
