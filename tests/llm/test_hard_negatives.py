from __future__ import annotations

import itertools
import math

import numpy as np
import pytest

from llm import hard_negatives, hilbert


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (5, 2)])
def test_curve_visits_each_cell_once_and_never_jumps(dims, bits):
    grid = np.array(list(itertools.product(range(1 << bits), repeat=dims)), np.uint32)
    place = hilbert.keys(grid, bits)
    order = sorted(range(len(grid)), key=place.__getitem__)
    assert len(set(place)) == len(grid)
    assert (np.abs(np.diff(grid[order].astype(int), axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_score():
    rng = np.random.default_rng(3)
    for scale in (10, 1000, 2**27):
        anchors, rows = (rng.integers(-scale, scale, (20, 16)) for _ in range(2))
        exact = anchors.astype(object) @ rows.astype(object).T
        low, high = hard_negatives.bounds(anchors, rows.min(axis=0)[None, :], rows.max(axis=0)[None, :])
        assert all(low[i, 0] <= min(exact[i]) and max(exact[i]) <= high[i, 0] for i in range(20))
        assert (hard_negatives.scores(anchors, rows).astype(object) == exact).all()


def brute(rows: list[tuple]) -> list[tuple]:
    part = set()
    for vec_id, vector, label in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        q = tuple(math.floor(256 * float(np.float32(x))) for x in vector)
        if sum(x * x for x in q) < 2**62:
            part.add((vec_id, q, int(math.fmod(label + 1, 10)) if vec_id % 7 == 0 else label))
    out = []
    for vec_id, q, label in part:
        if vec_id % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(q, p, strict=True)), other, mark) for other, p, mark in part if other != vec_id and len(p) == len(q)]
        for p, positive, _ in sorted(x for x in scored if x[2] == label)[:5]:
            fit = sorted((n, other) for n, other, mark in scored if mark != label and 30 * -p <= 100 * -n <= 90 * -p)[:10]
            out += [(vec_id, positive, rank, other, -p, -n) for rank, (n, other) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize(("block", "tile", "page", "cell"), [(1024, 1024, 256, 16), (7, 3, 2, 1)])
def test_equals_brute_force(spark, tables, monkeypatch, block, tile, page, cell):
    for name, value in (("BLOCK", block), ("TILE", tile), ("PAGE", page), ("_CELL", cell)):
        monkeypatch.setattr(hard_negatives, name, value)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(i * 4, (centres[rng.integers(6)] + rng.normal(size=8) * 0.3).tolist(), int(rng.choice([1, 1, 1, 2, 3, 9]))) for i in range(240)]
    rows += [(10000 + i, rows[0][1], 1) for i in range(120)]  # one vector holds a third of all rows
    rows += [rows[0], rows[25], (100, rows[1][1], 2), (None, rows[0][1], 1), (1100, None, 1), (1200, rows[0][1], None), (1300, [1.0] * 7 + [None], 1)]
    rows += [(1400, [1.0] * 7 + [float("nan")], 1), (1500, [float("inf")] * 8, 1), (1600, [], 1), (1601, [], 2), (1602, [], 1), (1700, [1.0, -1.0], 2), (1701, [1.0, -1.0], 2)]
    rows += [(1800, [1e30] * 8, 1), (1900, [2.0**20] * 8, 1), (1901, [2.0**20] * 8, 1), (-100, rows[3][1], 1), (-7, rows[3][1], 9)]
    sf_dir = tables(embeddings=[("vec_id", "embedding", "label", "score"), *((*r, "q") for r in rows)])
    got = sorted(tuple(r) for r in hard_negatives.op13_hard_negatives(spark, sf_dir).collect())
    assert got == brute(rows)
    assert len(got) > 500


def test_no_rows(spark, tables):
    assert hard_negatives.op13_hard_negatives(spark, tables(embeddings=[("vec_id", "embedding", "label")])).count() == 0
