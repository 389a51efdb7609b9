"""N-gram Jaccard join by chosen paths.

A document is the set of its five-word shingles. In each of RUNS runs a set is split recursively: it goes, for each of its
tokens (shingles) whose hash with the path so far is small enough, down the path that the token extends; on average
BRANCH / THRESHOLD tokens a level. Sets that share much share paths, others part. A path whose bucket holds up to SMALL
sets is not split further, one of DEPTH tokens not either; there every pair is compared exactly. Two sets of similarity
0.8 meet in at least one run with a probability of 99.6 % where the deepest buckets are needed, and of more than
99.99 % where the first ones are small.

Equal sets are one class before all that. A pair that meets in several buckets counts in the one of least number that
both have, so counts need no list of pairs; a bucket returns for each class its number of links and the least class
reached. Texts' shingles are fetched for those classes alone that count a pair somewhere. Buckets of DEPTH tokens that are
still large are dealt to tiles, and each two tiles are compared.

Cases: null and empty texts, and texts without words, link with nothing. Texts of fewer than five words are one shingle.
Repeated rows are documents that link with each other. A null doc_id is a document like others; its class may be null.
No rows: no rows. Other columns pass through `keep_one` as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import passing, per_batch, table, written
from llm.components import components, joined
from llm.words import hashed_words, mix, shingles

SIZE, THRESHOLD = 5, 0.8
RUNS, DEPTH, BRANCH = 8, 3, 1.2
#: Sets in a bucket up to which it is compared at once; sets in a tile of larger buckets at about.
SMALL, TILE = 64, 1024
_SEEDS = mix(np.arange(1, RUNS + 1, dtype=np.uint64))
_COLUMNS = 4096


def _sets(column: pa.Array) -> list[np.ndarray]:
    runs, bounds = shingles(*hashed_words(column), SIZE)
    return [np.unique(runs[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def _class(own: np.ndarray) -> int | None:
    return int((mix(own).sum(dtype=np.uint64) + np.uint64(len(own))).astype(np.int64)) if len(own) else None


def _paths(own: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each level (path before, path) of a set, over all runs."""
    most = min(BRANCH / THRESHOLD / len(own), 1.0) * 2.0**64
    most = np.uint64(min(most, 2.0**64 - 2048))
    before, out = _SEEDS, []
    for _ in range(DEPTH):
        path, token = np.nonzero(mix(own[None, :] ^ before[:, None]) <= most)
        after = mix(before[path] + mix(own[token]) * np.uint64(3))
        out.append(list(zip(before[path].astype(np.int64).tolist(), after.astype(np.int64).tolist(), strict=True)))
        before = after
    return out


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, row, cls (of equal sets; null without words) and the paths of each level."""
    kind = "array<struct<parent:long,path:long>>"

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            own = _sets(batch.column("text"))
            levels = [_paths(s) if len(s) else [[]] * DEPTH for s in own]
            out = {"doc_id": batch.column("doc_id"), "row": batch.column("row"), "cls": [_class(s) for s in own]}
            return out | {f"level{k}": [[{"parent": a, "path": b} for a, b in x[k]] for x in levels] for k in range(DEPTH)}

        return step

    return per_batch(docs, make, "doc_id long, row long, cls long, " + ", ".join(f"level{k} {kind}" for k in range(DEPTH)))


def _keyed(docs: DataFrame) -> DataFrame:
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(doc_id.alias("doc_id"), text.alias("text"), F.xxhash64(doc_id, text).alias("row"))


def _leaves(classes: DataFrame) -> DataFrame:
    """cls, leaf, n: the buckets of two classes or more in which each class is compared.

    A class goes down as one row: its paths that are still open are an array, by which the next level's array is filtered.
    """
    out, large = None, None
    for k in range(DEPTH):
        rows, level = classes, F.col(f"level{k}")
        if large is not None:
            # at most the paths of one level of one class, whatever the input
            rows = classes.join(large.groupBy("cls").agg(F.collect_set("path").alias("open")), "cls")
            level = F.filter(level, lambda x: F.array_contains("open", x["parent"]))
        paths = F.array_distinct(F.transform(level, lambda x: x["path"]))
        rows = rows.select("cls", F.explode(paths).alias("path"))
        counts = written(rows.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1"), "bucket-sizes")
        rows = written(rows.join(counts, "path"), "buckets")
        here = rows if k == DEPTH - 1 else rows.filter(F.col("n") <= SMALL)
        out = here if out is None else out.union(here)
        large = rows.filter(F.col("n") > SMALL)
    return written(out.select("cls", F.col("path").alias("leaf"), "n"), "leaves")


def by_group(df: DataFrame, keys: list[str], work: Callable[[dict], Iterator[dict]], schema: str) -> DataFrame:
    """df through a function of all rows of each key at once, many small groups to an Arrow batch.

    work gets the columns of one group (numpy, lists as object arrays) and yields dicts of columns.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    names = df.columns

    def run(batches):
        rest: pa.Table | None = None

        def groups(found: pa.Table, last: bool):
            change = np.zeros(max(found.num_rows - 1, 0), bool)
            for k in keys:
                v = np.asarray(found.column(k))
                change |= v[1:] != v[:-1]
            ends = [*(np.flatnonzero(change) + 1).tolist(), found.num_rows] if found.num_rows else []
            begins = [0, *ends[:-1]]
            if not last and ends:
                begins, ends = begins[:-1], ends[:-1]
            return list(zip(begins, ends, strict=True)), (ends[-1] if ends else 0)

        def made(found: pa.Table, spans: list[tuple[int, int]]):
            columns = {n: found.column(n).combine_chunks() for n in names}
            flat = {}
            for n, c in columns.items():
                if pa.types.is_list(c.type):
                    offsets, values = np.asarray(c.offsets), np.asarray(c.values)
                    flat[n] = lambda a, b, o=offsets, v=values: [v[o[i] : o[i + 1]] for i in range(a, b)]
                else:
                    flat[n] = lambda a, b, v=np.asarray(c): v[a:b]
            parts = [out for a, b in spans for out in work({n: get(a, b) for n, get in flat.items()})]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[f.name] for p in parts]), f.type) for f in arrow], schema=arrow)

        for batch in batches:
            own = pa.Table.from_batches([batch])
            found = own if rest is None else pa.concat_tables([rest, own])
            spans, at = groups(found, False)
            if at:
                yield from made(found, spans)
            rest = found.slice(at)
        if rest is not None and rest.num_rows:
            yield from made(rest, groups(rest, True)[0])

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _first_here(mine: list[np.ndarray], leaf: int, two: list[np.ndarray] | None = None) -> np.ndarray:
    """Which pairs have no common leaf below this one."""
    lower = [m[m < leaf] for m in mine]
    other = lower if two is None else [m[m < leaf] for m in two]
    values = np.unique(np.concatenate([*lower, *other])) if lower else np.zeros(0, np.int64)

    def holds(sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(sets), len(values) + 1), np.float32)
        out[np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.searchsorted(values, np.concatenate(sets))] = 1
        return out

    return holds(lower) @ holds(other).T == 0


def _common(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each two sets."""
    out = np.zeros((len(one), len(two)), np.float32)
    if len(one) * len(two) <= 4:
        for i, a in enumerate(one):
            for j, b in enumerate(two):
                out[i, j] = len(np.intersect1d(a, b, assume_unique=True))
        return out
    shared = np.intersect1d(np.concatenate(one), np.concatenate(two))
    flat = []
    for sets in (one, two):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        token = np.concatenate(sets)
        at = np.searchsorted(shared, token)
        found = (at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == token) if len(shared) else np.zeros(len(token), bool)
        order = np.argsort(at[found], kind="stable")
        flat.append((row[found][order], at[found][order]))
    for begin in range(0, len(shared), _COLUMNS):
        width = min(_COLUMNS, len(shared) - begin)
        parts = []
        for n, (row, at) in zip((len(one), len(two)), flat, strict=True):
            a, b = np.searchsorted(at, (begin, begin + width))
            held = np.zeros((n, width), np.float32)
            held[row[a:b], at[a:b] - begin] = 1
            parts.append(held)
        out += parts[0] @ parts[1].T
    return out


def _linked(g: dict) -> Iterator[dict]:
    """Of one bucket, or two tiles of one: links and least class reached of each class that has any."""
    side = g["tile"] == g["i"][0]
    one = np.flatnonzero(side)
    two = one if g["i"][0] == g["j"][0] else np.flatnonzero(~side)
    if len(one) == 0 or len(two) == 0:
        return
    sets, mine, leaf = g["tokens"], g["mine"], g["leaf"][0]
    sizes = np.array([len(s) for s in sets], np.float64)
    # `mine` decides which bucket counts a pair
    first = _first_here([mine[i] for i in one], leaf, [mine[i] for i in two])
    same = _common([sets[i] for i in one], [sets[i] for i in two])
    near = first & (same >= THRESHOLD * (sizes[one][:, None] + sizes[two][None, :] - same) - 1e-6) & (g["cls"][one][:, None] != g["cls"][two][None, :])
    a, b = np.nonzero(near)
    if not len(a):
        return
    links = np.zeros(len(side), np.int64)
    links += np.bincount(one[a], weights=g["copies"][two[b]], minlength=len(side)).astype(np.int64)
    if one is not two:
        links += np.bincount(two[b], weights=g["copies"][one[a]], minlength=len(side)).astype(np.int64)
    order = np.argsort(g["cls"], kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    labels = joined(np.arange(len(order)), rank[one[a]], rank[two[b]])
    found = np.flatnonzero(links)
    yield {"cls": g["cls"][found], "links": links[found], "root": g["cls"][order[labels[rank[found]]]]}


def _counting(g: dict) -> Iterator[dict]:
    """Of one small bucket: the classes that count a pair in it."""
    first = _first_here(g["mine"], g["leaf"][0])
    np.fill_diagonal(first, False)
    needed = first.any(axis=1)
    if needed.any():
        yield {"cls": g["cls"][needed], "leaf": g["leaf"][needed], "n": g["n"][needed]}


def join(docs: DataFrame) -> DataFrame:
    """doc_id, row, n_links, class_id (least doc_id reachable by links, its own included) and component of each row of docs.

    component tells classes apart even where they share their least doc_id; null without words.
    """
    docs = _keyed(docs)
    with passing(docs.sparkSession) as keep:
        named, of_class = _classes(docs)
        keep(named), keep(of_class)
    ends = named.filter("cls is not null").select("doc_id", "row", "cls").join(of_class, "cls").select("doc_id", "row", "n_links", "class_id", "component")
    return ends.union(named.filter("cls is null").selectExpr("doc_id", "row", "0L", "doc_id", "cast(null as long)"))


def _bucketed(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """doc_id, row, cls of each row; copies, first_id and a row of each class; the classes' buckets."""
    spark = docs.sparkSession
    with passing(spark) as keep:
        signed = written(_signed(docs), "signed")
        levels = [f"level{k}" for k in range(DEPTH)]
        sound = signed.filter("cls is not null")
        sizes = keep(written(sound.groupBy("cls").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"), F.min("row").alias("row")), "classes"))
        # one row of each class holds its paths; rows with equal doc_id and text share `row` and all else
        paths = sound.select("cls", "row", *levels).join(sizes.select("cls", "row"), ["cls", "row"], "left_semi").dropDuplicates(["cls"])
        paths = keep(written(paths, "paths"))
        named = keep(written(signed.select("doc_id", "row", "cls"), "named"))
    with passing(spark) as keep:
        leaves = keep(_leaves(paths))
    return named, sizes, leaves


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, row, cls of each row, and n_links, class_id and component of each class."""
    named, sizes, leaves = _bucketed(docs)
    with passing(docs.sparkSession) as keep:
        found = keep(_found(docs, sizes, leaves))
    whole = components(found.selectExpr("cls as a", "root as b"))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    least = whole.join(sizes, F.col("node") == F.col("cls")).groupBy("component").agg(F.min("first_id").alias("least"))
    of_class = sizes.join(links, "cls", "left").join(whole, F.col("cls") == F.col("node"), "left").join(least, "component", "left")
    of_class = of_class.selectExpr("cls", "copies - 1 + coalesce(links, 0) as n_links", "coalesce(least, first_id) as class_id", "coalesce(component, cls) as component")
    return named, written(of_class, "of-class")


def _found(docs: DataFrame, sizes: DataFrame, leaves: DataFrame) -> DataFrame:
    """cls, links, root: the links that each bucket counts, and the least class reached there."""
    mine = leaves.groupBy("cls").agg(F.sort_array(F.collect_set("leaf")).alias("mine")).join(sizes, "cls")
    mine = written(mine.select("cls", "mine", "copies", "row"), "mine")
    small = by_group(leaves.filter(F.col("n") <= SMALL).join(mine, "cls").select("leaf", "cls", "n", "mine"), ["leaf"], _counting, "cls long, leaf long, n long")
    needed = written(small.union(leaves.filter(F.col("n") > SMALL).select("cls", "leaf", "n")), "needed")
    members = mine.join(needed.select("cls").distinct(), "cls", "left_semi")

    def tokens():
        def step(batch: pa.RecordBatch) -> dict:
            own = _sets(batch.column("text"))
            return {"of": [_class(s) for s in own], "tokens": [s.astype(np.int64) for s in own]}

        return step

    text = docs.select("row", "text").join(members.select("row"), "row", "left_semi").select("text")
    sets = written(per_batch(text, tokens, "of long, tokens array<long>").dropDuplicates(["of"]), "sets")
    tiles = F.when(F.col("n") <= SMALL, F.lit(1)).otherwise(F.ceil(F.col("n") / TILE)).cast("int")
    dealt = needed.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    dealt = dealt.select("leaf", "cls", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))
    dealt = dealt.join(members.select("cls", "mine", "copies"), "cls").join(sets, F.col("cls") == F.col("of")).drop("of")
    return written(by_group(dealt, ["leaf", "i", "j"], _linked, "cls long, links long, root long"), "linked")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one row of each class: that of least doc_id, and of rows that share it one of least text hash.

    Rows without words link with nothing and all stay. Of rows equal in doc_id and text one stays, whatever else they hold.
    """
    with passing(docs.sparkSession) as keep:  # of all that finds them only the rows that stay are read later
        rows = written(join(docs.select("doc_id", "text")).groupBy("component", "doc_id", "row").agg(F.count("*").alias("copies")), "kept-of")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "copies"))
        kept = rows.filter("component is not null").groupBy("component").agg(first.alias("first")).selectExpr("first.row as row", "first.copies as copies")
        kept = keep(written(kept.union(rows.filter("component is null").selectExpr("row", "1L")), "kept"))
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    packed = docs.select(F.struct("*").alias("all"), F.xxhash64(doc_id, text).alias("row"))
    single = packed.join(kept.filter("copies = 1"), "row", "left_semi").select("all")
    # only rows that stand more than once are brought together
    many = packed.join(kept.filter("copies > 1"), "row", "left_semi").groupBy("row").agg(F.min_by("all", F.xxhash64(F.to_json("all"))).alias("all"))
    return single.union(many.select("all")).select(*[F.col(f"all.`{c}`").alias(c) for c in docs.columns])


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_links", "class_id", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)).alias("kept"))
