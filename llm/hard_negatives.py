"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Candidates are sorted by label and by their place on a Hilbert curve through all dimensions, and written as Parquet blocks of up to
BLOCK rows of one label. A block's zone map is the least and greatest value of each dimension; it is a column of its own, so
choosing blocks reads no vectors. For an anchor a, interval arithmetic bounds every score in a block: each dimension adds between
min(a * least, a * greatest) and max(a * least, a * greatest).

A window is what an anchor looks for: the `most` best scores of at most `high` and at least `low`, among rows of its own
label (positives) or of others (negatives, one window for each positive). Windows first read the PROBED blocks whose bounds
have the highest middle. Their last result so far is a floor that the whole answer can't fall below, and then every block is read whose
bounds meet the window above its floor. So the answer is exact, and bounds only spare work: they rule out much where labels or
copies lie close together, and little where 64 dimensions are independent.

Anchors travel in tiles of up to TILE to the zone maps (in pages of PAGE), tiles and pages being dealt to a grid, and from there with
the windows that need a block to that block. Vectors of a block are never sent to each anchor, and only a window's best rows leave
a block.

Cases: rows with a null vec_id, label or vector, or a null or non-finite component, take no part; nor do those whose squared length, in whole
numbers, is 2^62 or more, so that every score is a long. Vectors of different lengths don't compare; empty ones score 0. Rows that are
equal in vec_id, label and vector count as one; other rows that share a vec_id are rows of their own, but never each other's positives or
negatives, and each is an anchor. No rows: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm import hilbert
from llm.common import table, written

SCALE, POSITIVES, NEGATIVES = 256, 5, 10
#: A negative's score as a share of the positive's, in hundredths.
LEAST_SHARE, MOST_SHARE = 30, 90
#: Rows of a block, anchors of a tile, zone maps of a page, blocks that a window reads for its floor.
BLOCK, TILE, PAGE, PROBED = 1024, 1024, 256, 2
#: Tiles and pages that meet in one cell of the grid at about.
_CELL = 16
_LONG = np.iinfo(np.int64)
_ROWS = "dim int, label long, key binary, vec_id long, code binary"
_BLOCKS = "block long, dim int, label long, ids binary, codes binary, least binary, greatest binary"
_CHOSEN = "block long, tile long, windows binary, anchors binary, codes binary"
_FOUND = "tile long, window int, vec_id long, score long"


def relabelled(label: Column, vec_id: Column) -> Column:
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


def quantised(embeddings: DataFrame) -> DataFrame:
    """dim, label, key (place on the curve), vec_id, code (components as 32-bit whole numbers) of each row that takes part."""
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    rows = embeddings.select(vec_id.alias("vec_id"), relabelled(label, vec_id).alias("label"), F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.filter("vec_id is not null and label is not null and x is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            sizes = np.diff(np.asarray(x.offsets))
            flat = x.flatten()
            values = np.asarray(flat.fill_null(np.nan)) if len(flat) else np.zeros(0)
            ends = np.cumsum(sizes)
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                own = values[((ends - sizes)[at][:, None] + np.arange(dim)[None, :]).reshape(-1)].reshape(len(at), dim)
                good = np.isfinite(own).all(axis=1)
                own, at = np.floor(own[good] * SCALE), at[good]
                with np.errstate(over="ignore"):
                    good = (own * own).sum(axis=1) < 2.0**62
                own, at = own[good], at[good]
                place = hilbert.keys(hilbert.cells(own))
                code = own.astype("<i4")
                columns = [np.full(len(at), dim, np.int32), batch.column("label").take(at), place, batch.column("vec_id").take(at), [c.tobytes() for c in code]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary()), strict=True)], names=["dim", "label", "key", "vec_id", "code"])

    return rows.mapInArrow(run, _ROWS).dropDuplicates(["vec_id", "label", "code", "dim"])


def blocks(rows: DataFrame, most: int) -> DataFrame:
    """rows in curve order, up to `most` of one label and length to a block, with each block's zone map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        dim = label = None
        ids: list[np.ndarray] = []
        codes: list[bytes] = []

        def made() -> Iterator[pa.RecordBatch]:
            nonlocal number, ids, codes
            if codes:
                code = np.frombuffer(b"".join(codes), "<i4").reshape(len(codes), dim)
                line = (number, dim, label, np.array(ids, "<i8").tobytes(), code.tobytes(), code.min(axis=0).tobytes(), code.max(axis=0).tobytes())
                kinds = (pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(line, kinds, strict=True)], names=[c.split()[0] for c in _BLOCKS.split(", ")])
                number, ids, codes = number + 1, [], []

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("dim", "label", "vec_id", "code")]
            for d, lab, vec_id, code in zip(*columns, strict=True):
                if (d, lab) != (dim, label) or len(codes) == most:
                    yield from made()
                    dim, label = d, lab
                ids.append(vec_id)
                codes.append(code)
        yield from made()

    order = ["dim", "label", "key", "vec_id"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _BLOCKS)


def pages(found: DataFrame) -> DataFrame:
    """The zone maps of the blocks, PAGE to a row at most: dim, blocks, labels, least, greatest."""
    kinds = {"blocks": pa.int64(), "labels": pa.int64(), "least": pa.binary(), "greatest": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                for begin in range(0, len(own), PAGE):
                    part = batch.take(pa.array(own[begin : begin + PAGE]))
                    line = [dim, *(np.asarray(part.column(c)).astype("<i8").tobytes() for c in ("block", "label")), *(b"".join(part.column(c).to_pylist()) for c in ("least", "greatest"))]
                    yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int32()) for v in line], names=["dim", *kinds])

    return found.select("block", "dim", "label", "least", "greatest").mapInArrow(run, "dim int, blocks binary, labels binary, least binary, greatest binary")


def _grid(tiles: DataFrame, zones: DataFrame) -> DataFrame:
    """Each tile beside each page of its length, tiles and pages dealt to a grid of cells: neither side goes to one task."""
    across, down = (max(1, -(-df.count() // _CELL)) for df in (tiles, zones))
    left = tiles.withColumn("_across", F.pmod(F.xxhash64("tile"), F.lit(across))).withColumn("_down", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    right = zones.withColumn("_down", F.pmod(F.xxhash64("blocks"), F.lit(down))).withColumn("_across", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    return left.join(right, ["dim", "_across", "_down"]).drop("_across", "_down")


def bounds(anchors: np.ndarray, least: np.ndarray, greatest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest score possible of each anchor in each block; rounded outwards where doubles can't hold it."""
    a = anchors.astype(np.float64)
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    low, high = least.astype(np.float64).T, greatest.astype(np.float64).T
    lower, upper = up @ low + down @ high, up @ high + down @ low
    lost = (np.abs(a) @ np.maximum(np.abs(low), np.abs(high))) * (a.shape[1] + 2) * 2.0**-52
    lost = np.where(lost < 0.25, 0.0, lost)  # sums below 2^53 are exact
    return lower - lost, upper + lost


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, exactly: doubles where no sum reaches 2^53, else 64-bit whole numbers."""
    a, b = anchors.astype(np.float64), rows.astype(np.float64)
    reach = np.sqrt((a * a).sum(axis=1).max(initial=0) * (b * b).sum(axis=1).max(initial=0))
    if reach < 2.0**52:
        return (a @ b.T).astype(np.int64)
    return anchors.astype(np.int64) @ rows.astype(np.int64).T


#: Windows of a tile: the place of the anchor in the tile, the scores looked for, the floor known so far.
WINDOW = np.dtype([("anchor", "<i4"), ("low", "<i8"), ("high", "<i8"), ("floor", "<i8")])
#: What a chosen window takes along to a block.
_CHOICE = np.dtype([("window", "<i4"), ("anchor", "<i4"), ("floor", "<i8"), ("high", "<i8")])


def _chosen(same: bool, probe: int):
    """Tiles beside pages: the blocks that windows need, each with those windows and their anchors.

    With probe, a window names its `probe` blocks of the highest middle in this page, and `middle` is that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim, win = row["dim"], np.frombuffer(row["windows"], WINDOW)
                ids, zones = np.frombuffer(row["blocks"], "<i8"), [np.frombuffer(row[c], "<i4").reshape(-1, dim) if dim else np.zeros((len(row["blocks"]) // 8, 0)) for c in ("least", "greatest")]
                codes = np.frombuffer(row["codes"], "<i4").reshape(len(row["ids"]) // 8, dim)
                lower, upper = (x[win["anchor"]] for x in bounds(codes, *zones))
                fits = (np.frombuffer(row["labels"], "<i8") == row["label"]) == same
                need = fits[None, :] & (lower <= win["high"][:, None]) & (upper >= np.maximum(win["low"], win["floor"])[:, None])
                if probe:
                    middle = np.where(need, lower + upper, -np.inf)
                    best = np.argsort(-middle, axis=1, kind="stable")[:, :probe]
                    keep = np.take_along_axis(need, best, axis=1)
                    window, column = np.nonzero(keep)
                    out = [np.full(len(window), row["tile"]), window.astype(np.int32), ids[best[window, column]], middle[window, best[window, column]]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.float64()), strict=True)], names=["tile", "window", "block", "middle"])
                    continue
                for b in np.flatnonzero(need.any(axis=0)).tolist():
                    yield _to_block(int(ids[b]), row["tile"], np.flatnonzero(need[:, b]), win, codes, np.frombuffer(row["ids"], "<i8"))

    return run


def _to_block(block: int, tile: int, window: np.ndarray, win: np.ndarray, codes: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """One row for a block: the windows that read it, and the anchors of those windows alone."""
    used, place = np.unique(win["anchor"][window], return_inverse=True)
    choice = np.zeros(len(window), _CHOICE)
    choice["window"], choice["anchor"], choice["high"] = window, place, win["high"][window]
    choice["floor"] = np.maximum(win["low"], win["floor"])[window]
    line = (block, tile, choice.tobytes(), ids[used].tobytes(), codes[used].tobytes())
    return pa.RecordBatch.from_arrays([pa.array([v], pa.binary() if isinstance(v, bytes) else pa.int64()) for v in line], names=["block", "tile", "windows", "anchors", "codes"])


def _probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """tile with windows, and the windows that probe one block, as `_chosen` gives them."""
    for batch in batches:
        for row in batch.to_pylist():
            codes = np.frombuffer(row["codes"], "<i4").reshape(len(row["ids"]) // 8, row["dim"])
            yield _to_block(row["block"], row["tile"], np.sort(np.array(row["chosen"], np.int64)), np.frombuffer(row["windows"], WINDOW), codes, np.frombuffer(row["ids"], "<i8"))


def _read(most: int):
    """Blocks beside the windows that read them: each window's best rows of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim, win, ids = row["dim"], np.frombuffer(row["windows"], _CHOICE), np.frombuffer(row["ids"], "<i8")
                anchors = np.frombuffer(row["anchors"], "<i8")
                all_scores = scores(np.frombuffer(row["codes"], "<i4").reshape(len(anchors), dim), np.frombuffer(row["rows"], "<i4").reshape(len(ids), dim))
                out = []
                for w in win:
                    own = all_scores[w["anchor"]]
                    at = np.flatnonzero((own >= w["floor"]) & (own <= w["high"]) & (ids != anchors[w["anchor"]]))
                    if len(at) > most:
                        at = at[np.lexsort((ids[at], -own[at]))[:most]]
                    out.append((np.full(len(at), w["window"], np.int32), ids[at], own[at]))
                window, found, value = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), row["tile"], np.int64)), pa.array(window), pa.array(found), pa.array(value)], names=["tile", "window", "vec_id", "score"])

    return run


def _best(found: DataFrame, most: int) -> DataFrame:
    """rank of each of a window's `most` best rows; Spark keeps so many of each task before it shuffles them."""
    order = Window.partitionBy("tile", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _rows_of(chosen: DataFrame, candidates: DataFrame, most: int) -> DataFrame:
    return chosen.join(candidates.select("block", "dim", "ids", F.col("codes").alias("rows")), "block").mapInArrow(_read(most), _FOUND)


def _floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """windows with the floors found."""
    for batch in batches:
        windows = []
        for row in batch.to_pylist():
            win = np.frombuffer(row["windows"], WINDOW).copy()
            if row["floors"]:
                at = np.array([x["window"] for x in row["floors"]])
                win["floor"][at] = np.maximum(win["floor"][at], [x["floor"] for x in row["floors"]])
            windows.append(win.tobytes())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("tile", "dim", "label", "ids", "codes")), pa.array(windows, pa.binary())], names=["tile", "dim", "label", "ids", "codes", "windows"])


_TILES = "tile long, dim int, label long, ids binary, codes binary, windows binary"


def search(tiles: DataFrame, candidates: DataFrame, zones: DataFrame, most: int, same: bool) -> DataFrame:
    """tile, window, vec_id, score, rank: the `most` best rows of each window of tiles, exactly."""
    cells = _grid(tiles, zones).mapInArrow(_chosen(same, PROBED), "tile long, window int, block long, middle double")
    order = Window.partitionBy("tile", "window").orderBy(F.desc("middle"), "block")
    probed = cells.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= PROBED)
    probed = probed.groupBy("tile", "block").agg(F.collect_list("window").alias("chosen")).join(tiles, "tile").mapInArrow(_probes, _CHOSEN)
    seen = _best(_rows_of(probed, candidates, most), most)
    floors = seen.filter(F.col("rank") == most).groupBy("tile").agg(F.collect_list(F.struct("window", F.col("score").alias("floor"))).alias("floors"))
    tiles = written(tiles.join(floors, "tile", "left").mapInArrow(_floors, _TILES), "windows")
    return _best(_rows_of(_grid(tiles, zones).mapInArrow(_chosen(same, 0), _CHOSEN), candidates, most), most)


def _all_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One window for each anchor, open on both sides."""
    for batch in batches:
        windows = []
        for ids in batch.column("ids").to_pylist():
            win = np.zeros(len(ids) // 8, WINDOW)
            win["anchor"], win["low"], win["high"], win["floor"] = np.arange(len(win)), _LONG.min, _LONG.max, _LONG.min
            windows.append(win.tobytes())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("block", "dim", "label", "ids", "codes")), pa.array(windows, pa.binary())], names=["tile", "dim", "label", "ids", "codes", "windows"])


def _share_windows(least: int, most: int):
    """One window for each positive: window number n is the n-th of `of`, its scores between two shares of the positive's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows = []
            for of in batch.column("of").to_pylist():
                win = np.zeros(len(of), WINDOW)
                # least * p <= 100 * n <= most * p in whole numbers of any size
                win["anchor"] = [x["window"] for x in of]
                win["low"] = [max(-(-least * x["score"] // 100), int(_LONG.min)) for x in of]
                win["high"] = [most * x["score"] // 100 for x in of]
                win["floor"] = _LONG.min
                windows.append(win.tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("tile", "dim", "label", "ids", "codes")), pa.array(windows, pa.binary())], names=["tile", "dim", "label", "ids", "codes", "windows"])

    return run


def hard_negatives(embeddings: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST_SHARE, most: int = MOST_SHARE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows for which anchors (over vec_id) holds."""
    rows = written(quantised(embeddings), "quantised")
    candidates = written(blocks(rows, BLOCK), "blocks")
    zones = written(pages(candidates), "zone-maps")
    tiles = written(blocks(rows.filter(anchors), TILE).mapInArrow(_all_windows, _TILES), "anchors")
    found = written(search(tiles, candidates, zones, positives, True).select("tile", "window", "vec_id", "score", "rank"), "positives")
    # the windows of a tile: at most `positives` for each of its anchors, so the list is bounded
    of = found.groupBy("tile").agg(F.sort_array(F.collect_list(F.struct("window", "rank", "vec_id", "score"))).alias("of"))
    next_tiles = written(tiles.drop("windows").join(of, "tile").withColumn("windows", F.lit(None).cast("binary")).mapInArrow(_share_windows(least, most), _TILES), "negative-windows")
    hard = search(next_tiles, candidates, zones, negatives, False)
    at = of.select("tile", "of").join(tiles.select("tile", "ids"), "tile")
    named = written(at.mapInArrow(_named, "tile long, window int, anchor_id long, positive_id long, positive_score long"), "named")
    out = hard.join(named, ["tile", "window"])
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchor and positive of each negative window."""
    for batch in batches:
        for row in batch.to_pylist():
            ids, of = np.frombuffer(row["ids"], "<i8"), row["of"]
            out = [np.full(len(of), row["tile"], np.int64), np.arange(len(of), dtype=np.int32), ids[[x["window"] for x in of]], [x["vec_id"] for x in of], [x["score"] for x in of]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["tile", "window", "anchor_id", "positive_id", "positive_score"])


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE = """
with part as (
    select distinct vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
        list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
anchor as (select row_number() over () as a, * from part where vec_id % 100 = 0),
scored as (
    select a, n.vec_id as anchor_id, n.label = p.label as same, p.vec_id,
        list_sum(list_transform(list_zip(n.q, p.q), lambda z: z[1] * z[2]))::bigint as score
    from anchor n, part p where n.vec_id <> p.vec_id and len(n.q) = len(p.q)
),
positive as (select * from scored where same qualify row_number() over (partition by a order by score desc, vec_id) <= 5),
negative as (
    select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
        (row_number() over (partition by p.a, p.vec_id order by n.score desc, n.vec_id))::int as rank
    from positive p join scored n on n.a = p.a and not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negative where rank <= 10
"""
