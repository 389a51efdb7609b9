"""Near-duplicate vectors: int8 tile products with rigorous error bounds.

Equal vectors are one class first. Classes are dealt to tiles near a pivot; two tiles are compared unless the angle
between their pivots, less the widest angles within the tiles, rules every pair out. A comparison multiplies int8 codes
(exact in 32-bit floats, as sums stay below 2^24). For unit vectors x, y with codes' values x', y' the product x'y' is
off by at most |x - x'| + |x'| |y - y'|, a number known per vector; only pairs that it leaves possible are
computed again in double precision. A comparison returns, for each vector, how many it found and the least vector
reached, never pairs, so a large group of near copies costs time but no rows.

What a tile is compared with grows with the number of tiles: all pairs are looked at, unless the pivots rule them out.

Cases: vectors that are null, zero or hold null, NaN or infinite components link with nothing, nor do vectors of
different lengths. Equal rows count as one vector. A null vec_id links with nothing. No rows: no rows. Other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import table, written
from llm.components import components, joined

THRESHOLD = 0.95
#: Vectors a tile holds at about, and pivots at most; the pivots are the vectors of least hash.
TILE, PIVOTS = 8192, 256
_BLOCK = 1024
#: For what is lost in double precision itself.
_SLACK = 1e-9


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # first, so that squares neither overflow nor vanish
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return np.asarray(column.flatten()).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 1))


class Codes:
    """Int8 codes of unit vectors, their scales, and the bounds of what the codes lose."""

    def __init__(self, x: np.ndarray):
        self.scale = np.abs(x).max(axis=1) / 127
        code = np.rint(x / self.scale[:, None])
        value = code * self.scale[:, None]
        self.lost = np.sqrt(((x - value) ** 2).sum(axis=1)) + _SLACK
        self.length = np.sqrt((value * value).sum(axis=1)) + _SLACK
        self.code = code.astype(np.int8)


def linked(x: np.ndarray, y: np.ndarray, least: float):
    """Arrays of rows of x and of y whose cosine is at least `least`, block after block."""
    exact = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    cx, cy = Codes(x), Codes(y)
    right, lost = cy.code.T.astype(exact), cy.lost.max()
    scale = cy.scale.astype(exact)
    for at in range(0, len(x), _BLOCK):
        rows = slice(at, at + _BLOCK)
        near = cx.code[rows].astype(exact) @ right
        near *= scale
        # a little less than what is possible: 32-bit scales are off by a ten-millionth
        possible = (least - cx.lost[rows] - cx.length[rows] * lost) / cx.scale[rows]
        a, b = np.nonzero(near >= (possible - 1e-6 * np.abs(possible)).astype(exact)[:, None])
        if len(a) > 1 << 17:  # mostly copies: one product of all is cheaper than many of single pairs
            a, b = np.nonzero(x[rows] @ y.T >= least)
        else:
            fits = (near[a, b] * cx.scale[rows][a]) + cx.lost[rows][a] + cx.length[rows][a] * cy.lost[b] >= least - 1e-6
            a, b = a[fits], b[fits]
            sure = np.einsum("ij,ij->i", x[rows][a], y[b]) >= least
            a, b = a[sure], b[sure]
        yield a + at, b


def compare(one: pa.Table, two: pa.Table | None, least: float) -> dict:
    """id, links (vectors found, copies counted) and root (least id reached) of those that have any. two: None for one itself."""
    ids = np.concatenate([np.asarray(t.column("rep")) for t in (one, two) if t is not None])
    copies = np.concatenate([np.asarray(t.column("copies")) for t in (one, two) if t is not None])
    x = _unit(_matrix(one.column("embedding").combine_chunks()))
    y, shift = (x, 0) if two is None else (_unit(_matrix(two.column("embedding").combine_chunks())), len(x))
    rank = np.empty(len(ids), np.int64)
    order = np.argsort(ids, kind="stable")
    rank[order] = np.arange(len(ids))
    links, labels = np.zeros(len(ids), np.int64), np.arange(len(ids))
    for a, b in linked(x, y, least):
        if two is None:
            a, b = a[a != b], b[a != b]
        else:
            b = b + shift
            links += np.bincount(b, weights=copies[a], minlength=len(ids)).astype(np.int64)
        links += np.bincount(a, weights=copies[b], minlength=len(ids)).astype(np.int64)
        labels = joined(labels, rank[a], rank[b])
    found = np.flatnonzero(links)
    return {"id": ids[found], "links": links[found], "root": ids[order[labels[rank[found]]]]}


def near_duplicates(vectors: DataFrame, least: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of each vector."""
    rows = written(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding")).distinct(), "vectors")
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(finite & F.exists("embedding", lambda v: v != 0))
    reps = written(sound.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes")
    tiles, partners = _tiles(reps, least)
    found = written(_compared(tiles, partners, least), "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    whole = components(found.selectExpr("id as a", "root as b"))
    of_rep = written(
        reps.join(links, F.col("rep") == F.col("id"), "left").join(whole, F.col("rep") == F.col("node"), "left").selectExpr("rep", "embedding", "copies - 1 + coalesce(links, 0) as n_links", "coalesce(component, rep) as component_id"), "of-rep"
    )
    members = sound.alias("v").join(of_rep.alias("r"), F.col("v.embedding") == F.col("r.embedding")).select("vec_id", "n_links", "component_id")
    alone = rows.filter(F.col("vec_id").isNull() | F.col("embedding").isNull() | ~(finite & F.exists("embedding", lambda v: F.coalesce(v != 0, F.lit(False)))))
    return members.union(alone.selectExpr("vec_id", "0L", "vec_id")).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _tiles(reps: DataFrame, least: float) -> tuple[DataFrame, dict[int, list[int]]]:
    """The classes with their tile, and for each tile those of no lesser number that it is to be compared with."""
    wanted = min(PIVOTS, -(-reps.count() // TILE))  # more would only make the tiles smaller, and each be sent more often
    pivots = [r.embedding for r in reps.orderBy(F.xxhash64("embedding"), "rep").limit(wanted).collect()]
    by_size = {n: _unit(np.array([p for p in pivots if len(p) == n], np.float64)) for n in {len(p) for p in pivots}}
    sent = reps.sparkSession.sparkContext.broadcast(by_size)

    def place(batches):
        for batch in batches:
            column, n = batch.column("embedding"), batch.num_rows
            sizes = np.diff(np.asarray(column.offsets))
            pivot, angle = np.full(n, -1), np.full(n, np.pi)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                if (near := sent.value.get(int(size))) is not None:
                    cosine = _unit(_matrix(column.take(pa.array(own)))) @ near.T
                    pivot[own], angle[own] = cosine.argmax(axis=1), np.arccos(np.clip(cosine.max(axis=1), -1, 1))
            out = [batch.column("rep"), column, batch.column("copies"), pa.array(sizes, pa.int32()), pa.array(pivot, pa.int32()), pa.array(angle)]
            yield pa.RecordBatch.from_arrays(out, names=["rep", "embedding", "copies", "size", "pivot", "angle"])

    placed = written(reps.select("rep", "embedding", "copies").mapInArrow(place, "rep long, embedding array<float>, copies long, size int, pivot int, angle double"), "placed")
    cells = placed.groupBy("size", "pivot").agg(F.count("*").alias("n"), F.max("angle").alias("wide")).orderBy("size", "pivot").collect()
    first, tiles = {}, []
    for c in cells:  # a cell of many vectors is several tiles
        first[(c["size"], c.pivot)] = (len(tiles), -(-c.n // TILE))
        tiles += [c] * -(-c.n // TILE)
    partners: dict[int, list[int]] = {}
    reach = np.arccos(least)
    for i, a in enumerate(tiles):
        partners[i] = []
        for j in range(i, len(tiles)):
            b = tiles[j]
            if a["size"] == b["size"]:
                known = a.pivot >= 0 and b.pivot >= 0
                between = float(np.arccos(np.clip(by_size[a["size"]][a.pivot] @ by_size[a["size"]][b.pivot], -1, 1))) if known else 0.0
                if not known or between - a.wide - b.wide <= reach + 1e-6:
                    partners[i].append(j)
    at = placed.sparkSession.createDataFrame([(s, p, *v) for (s, p), v in first.items()] or [(0, 0, 0, 1)], "of_size int, of_pivot int, first int, n int")
    here = placed.join(F.broadcast(at), (F.col("size") == F.col("of_size")) & (F.col("pivot") == F.col("of_pivot")))  # PIVOTS rows for each length
    return here.select("rep", "embedding", "copies", (F.col("first") + F.pmod(F.xxhash64("rep"), F.col("n"))).cast("int").alias("tile")), partners


def _compared(tiles: DataFrame, partners: dict[int, list[int]], least: float) -> DataFrame:
    spark = tiles.sparkSession
    pairs = [(t, i, j) for i, js in partners.items() for j in js for t in {i, j}]
    pairs = spark.createDataFrame(pairs or [(-1, -1, -1)], "of int, i int, j int")
    dealt = tiles.join(pairs, F.col("tile") == F.col("of")).select("i", "j", "tile", "rep", "embedding", "copies")

    def work(key, group):
        i, j = (k.as_py() for k in key)
        tile = np.asarray(group.column("tile"))
        one = group.filter(pa.array(tile == i))
        out = compare(one, None if i == j else group.filter(pa.array(tile == j)), least)
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return dealt.groupBy("i", "j").applyInArrow(work, "id long, links long, root long")


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: The same rows by DuckDB, from all pairs.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), good AS (
  SELECT vec_id, e FROM v WHERE vec_id IS NOT NULL AND e IS NOT NULL
    AND list_count(e) = len(e) AND len(list_filter(e, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach(n, r) AS (
  SELECT a, b FROM links UNION SELECT reach.n, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT v.vec_id, coalesce(l.n, 0) AS n_links, least(v.vec_id, coalesce(c.m, v.vec_id)) AS component_id, v.vec_id <= coalesce(c.m, v.vec_id) AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = v.vec_id LEFT JOIN (SELECT n, min(r) AS m FROM reach GROUP BY n) c ON c.n = v.vec_id
"""
