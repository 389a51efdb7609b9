"""The whole run: repeatable, incremental, registered by name."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderloom.plans import batch, gold, kpi
from orderloom.schemas import ENTITIES, MULTILINE_ENTITIES
from orderloom.sources import tables
from testbed.fixtures import raw
from tests.helpers import rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    from orderloom import Lake

    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    options = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    for entity in ENTITIES:
        quoting = {"quote": '"', "escape": '"'} if entity in MULTILINE_ENTITIES else {}
        raw(spark, SF_DIR, entity).write.options(**options, **quoting).csv(lake.raw(entity))
    batch.run_batch(spark, lake, "r1")
    return lake


def _counts(spark, lake):
    paths = [lake.silver(e) for e in ENTITIES] + [lake.quarantine(e) for e in ENTITIES]
    paths += [lake.gold(t) for t in gold.TABLES]
    return {path: tables.read_path(spark, path).count() for path in paths}


def test_repeating_a_run_changes_nothing(spark, built):
    before = _counts(spark, built)
    batch.run_batch(spark, built, "r1")
    assert _counts(spark, built) == before


def test_a_new_run_adds_to_quarantine_only(spark, built):
    before = _counts(spark, built)
    batch.run_batch(spark, built, "r2")
    after = _counts(spark, built)
    for path, count in before.items():
        assert after[path] == (2 * count if "/quarantine/" in path else count)


@pytest.mark.parametrize("name", kpi.REPORTS)
def test_report_on_stored_tables_equals_report_on_lazy_ones(spark, built, name):
    from testbed.queries import QUERIES

    stored, lazy = batch.report(spark, built, name), QUERIES[name](spark, SF_DIR)
    assert [tuple(r) for r in stored.collect()] == [tuple(r) for r in lazy.collect()] or rows(stored) == rows(lazy)


def test_a_tolerant_run_sets_unreadable_rows_aside(spark, lake, tmp_path):
    folder = tmp_path / "raw" / "sellers"
    folder.mkdir(parents=True)
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    (folder / "a.csv").write_text(header + f"{'a' * 32},1,recife,PE\n{'b' * 32},x1,natal,RN\n")
    batch.ingest(spark, lake, ["sellers"])
    with pytest.raises(PySparkException):
        batch.refine(spark, lake, "sellers", "r1")
    batch.refine(spark, lake, "sellers", "r1", tolerant=True)
    assert rows(tables.read_path(spark, lake.silver("sellers")), "seller_city") == [("Recife",)]
    aside = tables.read_path(spark, lake.quarantine("sellers_unparsed"))
    assert rows(aside, "seller_zip_code_prefix", "error_reason") == [("x1", "seller_zip_code_prefix is not a valid int")]


def test_tables_are_queryable_by_name(spark, built):
    batch.register(spark, built, "t_")
    assert tables.list_tables(spark, "t_gold").count() == len(gold.TABLES)
    by_name = spark.sql("SELECT count(*) AS n FROM t_gold.fact_orders").first().n
    assert by_name == tables.read_path(spark, built.gold("fact_orders")).count()
    assert tables.query_path(spark, built.gold("fact_orders"), "count(*) AS n").first().n == by_name


def test_names_see_what_later_runs_write(spark, built):
    batch.register(spark, built, "u_")
    facts = spark.sql("SELECT count(*) AS n FROM u_gold.fact_orders").first().n
    rejected = spark.sql("SELECT count(*) AS n FROM u_quarantine.orders").first().n
    assert rejected == tables.read_runs(spark, built.quarantine("orders")).count() > 0
    batch.run_batch(spark, built, "2024-01-05")
    assert spark.sql("SELECT count(*) AS n FROM u_gold.fact_orders").first().n == facts
    runs = spark.sql("SELECT run_id, count(*) AS n FROM u_quarantine.orders GROUP BY run_id")
    assert "2024-01-05" in {r.run_id for r in runs.collect()} and sum(r.n for r in runs.collect()) > rejected


def test_an_overwrite_that_fails_leaves_the_old_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.overwrite(spark.range(10), path)
    with pytest.raises(PySparkException):
        tables.overwrite(spark.sql("SELECT CAST(concat('x', id) AS INT) AS id FROM range(5)"), path)
    assert tables.read_path(spark, path).count() == 10
    tables.overwrite(tables.read_path(spark, path).filter("id < 3"), path)
    assert rows(tables.read_path(spark, path)) == [(0,), (1,), (2,)]


@pytest.mark.parametrize("run_id", ["été", "a/b=c%20d", "it's", "007", " x "])
def test_run_ids_come_back_as_given(spark, tmp_path, run_id):
    for rows_ in (3, 2):
        tables.write_run(spark.range(rows_), f"{tmp_path}/q", run_id)
    assert {tuple(r) for r in tables.read_runs(spark, f"{tmp_path}/q").collect()} == {(0, run_id), (1, run_id)}


def test_an_empty_run_id_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="empty"):
        tables.write_run(spark.range(1), f"{tmp_path}/q", "")


def test_readers_see_whole_versions(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    tables.overwrite(spark.range(10), path)
    begun = tables.read_path(spark, path)
    seen = []
    switch = tables._filesystem

    def between(session, at):  # the new files are complete and not yet current
        if "/_current/1." in at:
            seen.append(tables.read_path(session, path).count())
        return switch(session, at)

    monkeypatch.setattr(tables, "_filesystem", between)
    tables.overwrite(spark.range(3), path)
    assert seen == [10]
    assert (tables.read_path(spark, path).count(), begun.count()) == (3, 10)  # who had begun goes on
    assert len(tables.retire(spark, path, 0)) == 1
    assert tables.read_path(spark, path).count() == 3 and tables.retire(spark, path, 0) == []


def test_a_switch_that_fails_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    tables.overwrite(spark.range(10), path)

    class Refusing:
        def createNewFile(self, pointer):
            return False

    switch = tables._filesystem
    monkeypatch.setattr(tables, "_filesystem", lambda session, at: (Refusing(), at) if "/_current/1." in at else switch(session, at))
    with pytest.raises(OSError, match="as before"):
        tables.overwrite(spark.range(3), path)
    monkeypatch.undo()
    assert tables.read_path(spark, path).count() == 10
    tables.overwrite(spark.range(3), path)
    assert tables.read_path(spark, path).count() == 3


def test_a_named_table_is_switched_in_the_catalog(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS switched")
    path = f"{tmp_path}/t"
    tables.replace_table(spark.range(10), "switched.t", path)
    assert spark.table("switched.t").count() == 10
    tables.overwrite(spark.range(4), path)
    assert spark.table("switched.t").count() == 10  # by name the old version, whole, until the catalog is told
    tables.register(spark, "switched.t", path)
    assert spark.table("switched.t").count() == 4
    tables.replace_table(spark.table("switched.t").filter("id > 0"), "switched.t", path)
    assert rows(spark.table("switched.t")) == [(1,), (2,), (3,)]
    tables.replace_table(spark.range(2).selectExpr("id", "'x' as more"), "switched.t", path)
    assert rows(spark.table("switched.t")) == [(0, "x"), (1, "x")]


def test_scratch_root_is_in_a_shared_folder(spark):
    from orderloom import scratch_root

    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    assert scratch_root(spark) != scratch_root(spark)
    assert scratch_root(spark).startswith(shared.rstrip("/"))


def test_tables_are_small_and_their_shuffles_go(spark, tmp_path):
    """Ids in hexadecimal take about half their characters, and writing leaves no setting behind, side by side or nested."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    seen = []
    ids = spark.range(40_000).select(F.md5(F.col("id").cast("string")).alias("id")).repartition(2)
    batch.each(spark, ["a", "b", "c"], lambda name: tables.overwrite(ids, f"{tmp_path}/{name}"))
    with tables._shuffles_go(spark):
        seen.append(spark.conf.get(key))
        tables.write_run(ids, f"{tmp_path}/runs", "r1")
        seen.append(spark.conf.get(key))
    assert seen == ["true", "true"] and spark.conf.get(key, None) == before
    for name in ("a", "b", "c", "runs"):
        size = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(tmp_path / name) for f in fs if f.endswith(".parquet"))
        assert size < 40_000 * 32 * 0.7


def test_a_run_can_free_what_it_replaces(spark, lake):
    """A second run with retire_after=0 leaves one version of each table, with the same rows."""
    sellers = spark.createDataFrame([("s1", "x"), ("s2", "y")], "seller_id string, seller_city string")
    for _ in range(2):
        tables.overwrite(sellers, lake.gold("dim_sellers"))
    tables.overwrite(sellers.select("seller_id", F.lit("1").alias("seller_zip_code_prefix"), "seller_city", F.lit("SP").alias("seller_state")), lake.silver("sellers"))
    batch.publish_gold(spark, lake, "dim_sellers", retire_after=0)
    assert len(tables.matching(spark, f"{lake.gold('dim_sellers')}/version-*")) == 1
    assert tables.read_path(spark, lake.gold("dim_sellers")).count() == 2
