"""What the queries land: compressed files, whole."""

from __future__ import annotations

from pathlib import Path

from orderloom.plans import batch
from orderloom.sources import landing
from testbed.queries import _land, _land_csv
from tests.helpers import rows


def test_landed_files_are_compressed_and_come_back_whole(spark, lake):
    sent = spark.createDataFrame([(f"{n:032x}", str(n), " São  Paulo, x", None) for n in range(50)], "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    _land_csv(sent, lake.raw("sellers"))
    landed = [p.name for p in Path(lake.raw("sellers")).glob("part-*")]
    assert landed and all(n.endswith(".csv.gz") for n in landed)
    batch.ingest(spark, lake, ["sellers"])
    assert rows(batch.bronze(spark, lake, "sellers").drop("_rescued_data")) == rows(sent)
    assert all(".zstd." in p.name for p in Path(_land(sent, f"{lake.root}/t")).glob("part-*"))


def test_headers_are_first_lines_whatever_a_task_holds_and_spills(spark, tmp_path):
    """Five files in one task, more lines than its sorts may hold: each first line is still its file's."""
    for n in range(5):
        (tmp_path / f"{n}.csv").write_text("a,b\n" + "".join(f"{n},{k}\n" for k in range(3000)))
    together = {"spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    spills, threshold = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().conf(), "spark.shuffle.spill.numElementsForceSpillThreshold"
    spills.set(threshold, "500")
    for key, value in together.items():
        spark.conf.set(key, value)
    try:
        (layout,) = landing.layouts(spark, [str(tmp_path)])
    finally:
        spills.remove(threshold)
        for key in together:
            spark.conf.unset(key)
    assert layout.names == ("a", "b") and len(layout.paths) == 5
