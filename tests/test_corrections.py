"""Corrections that later runs keep, ledgers written with a run, and streams under supervision."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderloom.plans import batch, corrections
from orderloom.schemas import EVENT_SCHEMAS
from orderloom.sources import tables
from orderloom.streaming import silver as stream_silver
from orderloom.streaming import supervise
from testbed.fixtures import bodies
from tests.helpers import rows

SF_DIR = "/root/testdata/sf0.001"
HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def _sellers(tmp_path, name: str, *lines: tuple) -> None:
    folder = tmp_path / "raw" / "sellers"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(HEADER + "".join(f"{','.join(map(str, line))}\n" for line in lines))


def _fix(**values):
    return lambda df: df.withColumns({c: F.lit(v) for c, v in values.items()})


def test_corrections_outlive_rebuilds(spark, lake, tmp_path):
    good, bad, worse = "a" * 32, "b" * 32, "c" * 32
    _sellers(tmp_path, "a.csv", (good, 1, "recife", "PE"), (bad, -5, "natal", "RN"), (worse, -7, "12345", "SP"))
    batch.ingest(spark, lake, ["sellers"])
    batch.refine(spark, lake, "sellers", "r1")
    assert rows(tables.read_path(spark, lake.silver("sellers")), "seller_id") == [(good,)]
    sign = lambda df: df.withColumn("seller_zip_code_prefix", F.abs("seller_zip_code_prefix"))
    corrections.correct(spark, lake, "sellers", "signs", sign, "r1")
    for run in ("r2", "r3"):  # the second rebuild keeps it as well
        batch.refine(spark, lake, "sellers", run)
        assert rows(tables.read_path(spark, lake.silver("sellers")), "seller_id", "seller_zip_code_prefix") == [(good, 1), (bad, 5)]
    states = {(r[corrections.ID], r.state) for r in corrections.ledger(spark, lake, "sellers").collect()}
    assert states == {("signs", corrections.FIXED), ("signs", corrections.AGAIN)}
    only = lambda df: _fix(seller_zip_code_prefix=9, seller_city="Santos")(df.filter(F.col("seller_id") == worse).filter("seller_zip_code_prefix = -7"))
    corrections.correct(spark, lake, "sellers", "cities", only, "r1")
    batch.refine(spark, lake, "sellers", "r4")
    assert rows(tables.read_path(spark, lake.silver("sellers")), "seller_id", "seller_zip_code_prefix") == [(good, 1), (bad, 5), (worse, 9)]
    found = sorted((r[corrections.ID], r.state) for r in corrections.ledger(spark, lake, "sellers").collect())
    assert found == [("cities", corrections.FIXED), ("signs", corrections.FIXED), ("signs", corrections.SUPERSEDED)]


def test_a_repeated_correction_replaces_itself(spark, lake, tmp_path):
    _sellers(tmp_path, "a.csv", ("b" * 32, -5, "natal", "RN"), ("b" * 32, -5, "natal", "RN"))
    batch.ingest(spark, lake, ["sellers"])
    for run in ("r1", "r2"):
        batch.refine(spark, lake, "sellers", run)
    for zip_code in (6, 7):  # the row is in two runs' quarantines and is mended once
        corrections.correct(spark, lake, "sellers", "again", _fix(seller_zip_code_prefix=zip_code))
    batch.refine(spark, lake, "sellers", "r3")
    assert rows(tables.read_path(spark, lake.silver("sellers")), "seller_zip_code_prefix") == [(7,)]


def test_a_run_counts_what_it_writes(spark, lake, tmp_path):
    _sellers(tmp_path, "a.csv", ("a" * 32, 1, "recife", "PE"), ("b" * 32, -5, "natal", "RN"))
    batch.ingest(spark, lake, ["sellers"])
    for _ in range(2):
        batch.refine(spark, lake, "sellers", "r1")
    lines = {r.side: (r.row_count, r.null_counts["seller_city"]) for r in tables.read_runs(spark, lake.path("ledger", "sellers")).collect()}
    assert lines == {"valid": (1, 0), "rejected": (1, 0)}


def _landed(spark, lake):
    for table in EVENT_SCHEMAS:
        bodies(spark, SF_DIR, table).write.parquet(lake.path("stream_bronze", table))


def test_supervision_logs_each_batch(spark, lake):
    _landed(spark, lake)
    log = supervise.Log(spark, lake.path("stream_log", "batches"))
    running = stream_silver.start_all(spark, lake, None, with_quarantine=True)
    supervise.supervise(spark, running, log, every=0.2)
    found = tables.read_path(spark, lake.path("stream_log", "batches")).collect()
    assert {r.event_table for r in found} == set(EVENT_SCHEMAS)
    for r in found:
        kept = tables.read_path(spark, lake.path("stream_silver", r.event_table)).count()
        rejected = tables.read_path(spark, lake.path("stream_quarantine", r.event_table)).count()
        assert (r.rows_in, r.kept_rows, r.rejected_rows) == (bodies(spark, SF_DIR, r.event_table).count(), kept, rejected)
        assert r.batch_ms > 0 and r.behind_ms >= 0 and r.started is not None


def test_one_failing_stream_stops_the_others(spark, lake, monkeypatch):
    _landed(spark, lake)
    clean = stream_silver.tag_events

    def broken(batch, table, schema=None):
        if table == "payments":
            raise ValueError("no such cleaner")
        return clean(batch, table, schema)

    monkeypatch.setattr(stream_silver, "tag_events", broken)
    running = stream_silver.start_all(spark, lake, "1 second", with_quarantine=True)
    with pytest.raises(PySparkException, match="no such cleaner"):
        supervise.supervise(spark, running, every=0.2)
    assert not any(q.isActive for q in running.values())
    monkeypatch.setattr(stream_silver, "tag_events", clean)
    again = stream_silver.start_all(spark, lake, None, with_quarantine=True)
    supervise.supervise(spark, again, every=0.2)
    assert tables.read_path(spark, lake.path("stream_silver", "payments")).count() > 0


def test_orderly_rows_of_a_stream_by_name(spark, lake):
    _landed(spark, lake)
    for q in stream_silver.start_all(spark, lake, None, prefix="named_", only=["orders"]).values():
        q.awaitTermination()
    by_path = tables.read_path(spark, lake.path("stream_silver", "orders")).count()
    assert spark.table("named_stream_silver.orders").count() == by_path > 0
    batch.register(spark, lake, "known_")
    assert spark.table("known_stream_silver.orders").count() == by_path
