from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import fingerprints
from tests.llm.conftest import SF_DIR, real, words


def shingles(text: str | None) -> set:
    own = words(text)
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)} or ({tuple(own)} if own else set())


def jaccard(a: str, b: str) -> float:
    one, two = shingles(a), shingles(b)
    return len(one & two) / len(one | two) if one | two else 1.0


def test_empty_bins_take_the_first_in_their_order():
    rng = np.random.default_rng(1)
    order, _ = fingerprints._orders()
    least = np.full((40, fingerprints.BINS), fingerprints._EMPTY)
    for i, row in enumerate(least):
        held = rng.choice(fingerprints.BINS, i * i // 4 + 1, replace=False)
        row[held] = rng.integers(1, 1 << 40, len(held))
    dense = fingerprints._dense(least)
    for row, found in zip(least, dense, strict=True):
        for b in range(fingerprints.BINS):
            source = b if row[b] != fingerprints._EMPTY else next(j for j in order[b] if row[j] != fingerprints._EMPTY)
            assert found[b] == row[source]


def test_estimates_are_unbiased():
    rng = np.random.default_rng(2)
    vocabulary = np.array([f"w{i}" for i in range(5000)])
    off = []
    for size in (30, 300, 3000):
        for share in (0.1, 0.5, 0.9):
            one = vocabulary[rng.integers(0, 5000, size)]
            two = one.copy()
            two[int(size * share) :] = vocabulary[rng.integers(0, 5000, size - int(size * share))]
            pair = [" ".join(one), " ".join(two)]
            bits, some = fingerprints.packed(pa.array(pair))
            off.append(fingerprints.likeness(bits[:1], bits[1:], some[:1], some[1:])[0] - jaccard(*pair))
    assert abs(np.mean(off)) < 0.03 and np.max(np.abs(off)) < 0.12


def test_all_rows_equal_plain_python(spark):
    rows = sorted(real("documents"), key=lambda r: r["doc_id"])
    got = {r.doc_id: r for r in fingerprints.op11_fingerprints(spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    off = []
    for row, after in zip(rows, [*rows[1:], rows[0]], strict=True):
        text, following = row["text"] or "", after["text"] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        found = got[row["doc_id"]]
        assert (found.n_chars, found.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        off += [found.near_edited - jaccard(text, edited), found.near_next - jaccard(text, following)]
    assert abs(np.mean(off)) < 0.01 and np.max(np.abs(off)) < 0.12


@pytest.mark.parametrize("parts", [1, 7])
def test_edges(spark, tables, parts):
    long = " ".join(f"wort{i % 977}é" for i in range(40000))
    values = [(None, "no id here at all", "x"), (1, None, "x"), (2, "", "x"), (3, "!?", "x"), (4, "One two\U0001f600", "x"), (5, long, "x"), (6, "one TWO\U0001f600", "x")]
    values += [(7, "the same text each time it stands", "y")] * 9 + [(7, f"another text number {i} under one id", "z") for i in range(3)]
    sf_dir = tables(documents=[("doc_id", "text", "fingerprint"), *values])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = fingerprints.op11_fingerprints(spark, sf_dir).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(values)
    by_id = {r.doc_id: r for r in got if r.doc_id != 7}
    texts = [v[1] or "" for v in values]
    for i in range(6):  # all but the last before the shared id have one certain next document
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[i + 1][:half]
        found = by_id[values[i][0]]
        assert found.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert by_id[1].fingerprint == by_id[2].fingerprint == by_id[3].fingerprint == ""
    assert (by_id[1].near_next, by_id[3].near_next, by_id[3].near_edited) == (1.0, 0.0, 0.0) or by_id[3].near_edited == 1.0
    assert by_id[4].fingerprint == by_id[6].fingerprint != ""
    repeated = [r for r in got if r.doc_id == 7]
    assert len({r.fingerprint for r in repeated}) == 4 and sum(r.near_next == 1.0 for r in repeated) >= 8


def test_own_columns(spark):
    docs = spark.createDataFrame([("a", "one two three", 1), ("b", "one two three", 2), ("c", None, 3)], "fingerprint string, text string, near int")
    found = fingerprints.fingerprints(docs)
    assert found.columns == ["text", "near", "fingerprint"]
    both = found.alias("x").join(found.alias("y"), F.lit(True)).select(F.col("x.near").alias("i"), F.col("y.near").alias("j"), F.col("x.fingerprint").alias("a"), F.col("y.fingerprint").alias("b"))
    got = {(r.i, r.j): r.near for r in fingerprints.near(both, "a", "b", "near").collect()}
    assert got == {(i, j): float((i == 3) == (j == 3)) for i in (1, 2, 3) for j in (1, 2, 3)}
    other = spark.createDataFrame([(" ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(25, 90)))], "x string, y string")
    one = fingerprints.fingerprints(other.select(F.col("x").alias("text"))).first().fingerprint
    two = fingerprints.fingerprints(other.select(F.col("y").alias("text"))).first().fingerprint
    bits = [np.frombuffer(bytes.fromhex(f), np.uint8)[None, :] for f in (one, two)]
    exact = fingerprints.likeness(*bits, np.array([True]), np.array([True]))[0]
    assert abs(fingerprints.near(spark.createDataFrame([(one, two)], "a string, b string"), "a", "b", "n").first().n - exact) < 1e-12


def test_no_rows(spark, tables):
    assert fingerprints.op11_fingerprints(spark, tables(documents=[("doc_id", "text")])).count() == 0
