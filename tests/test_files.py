"""CSV ingestion: incremental reads, header checks, line breaks, drift and rescue."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import IntegerType, StringType

from orderloom.plans import batch
from orderloom.schemas import raw_schema
from orderloom.sources import files, landing
from tests.helpers import rows


def _drop(folder, name: str, text: str) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8", newline="")


HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def test_each_file_is_ingested_once(spark, lake, tmp_path):
    folder = tmp_path / "raw" / "sellers"
    _drop(folder, "a.csv", HEADER + "s1,1,recife,PE\n")
    batch.ingest(spark, lake, ["sellers"])
    batch.ingest(spark, lake, ["sellers"])
    assert batch.bronze(spark, lake, "sellers").count() == 1
    _drop(folder, "b.csv", HEADER + "s2,2,natal,RN\n")
    batch.ingest(spark, lake, ["sellers"])
    assert rows(batch.bronze(spark, lake, "sellers"), "seller_id") == [("s1",), ("s2",)]


def test_files_of_several_layouts_lie_side_by_side(spark, lake, tmp_path):
    folder = tmp_path / "raw" / "sellers"
    _drop(folder, "a.csv", HEADER + "s1,1,recife,PE\n")
    _drop(folder, "b [1] é%20.csv", "seller_zip_code_prefix,seller_id,seller_city,seller_state\r\n2,s2,natal,RN\r\n")
    _drop(folder, "c.csv", "\ufeffseller_id,seller_group,seller_state\ns3,g3,SP\n")
    _drop(folder, "empty.csv", "")
    batch.ingest(spark, lake, ["sellers"])
    _drop(folder, "d.csv", "seller_state,seller_id,seller_rank,seller_group\nRJ,s4,7,\n")
    batch.ingest(spark, lake, ["sellers"])
    known = rows(batch.bronze(spark, lake, "sellers").drop(files.RESCUED))
    assert known == [("s1", "1", "recife", "PE"), ("s2", "2", "natal", "RN"), ("s3", None, None, "SP"), ("s4", None, None, "RJ")]
    every = batch.bronze(spark, lake, "sellers", every_column=True)
    assert rows(every, "seller_id", "seller_group", "seller_rank") == [("s1", None, None), ("s2", None, None), ("s3", "g3", None), ("s4", None, "7")]
    history = landing.schema_history(spark, lake.schema_file("sellers"))
    assert [c.added for c in history] == [("seller_group",), ("seller_rank",)]
    assert set(history[0].missing) == {"seller_zip_code_prefix", "seller_city", "seller_group"} - {"seller_group"}


def test_column_names():
    assert landing.column_names('a,"b, c",,a') == ("a0", "b, c", "_c2", "a3")


REVIEWS = [
    'r1,"a ""good"" one","line 1\nline 2, same field\r\nline 3"\n',
    "r2,plain,short\n",
    'r3,"","' + "x\n" * 900 + '"\n',
    "\n",
    'r4,,"é, ü"\n',
    "r5,too few\n",
    'r6,"ends with quote""",""""\n',
]


@pytest.mark.parametrize("last", ["r7,a,b\n", "r7,a,b", 'r7,"never closed\nr8,a,b\nr9,c,d'])
def test_splits_give_the_records_of_one_task(spark, tmp_path, last):
    text = "id,title,message\n" + "".join(REVIEWS) * 3 + last
    _drop(tmp_path / "m", "a.csv", text)
    _drop(tmp_path / "m", "b.csv", 'id,title,message\nq1,"one\nfile",more\n')
    schema = files.with_rescue(spark.createDataFrame([], "id string, title string, message string").schema)
    one_task = files.csv_table(spark, f"{tmp_path}/m", spark.createDataFrame([], "id string, title string, message string").schema, multiline=True, rescue=True)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(len(text.encode()) // 3 + 1))
    try:
        layout = landing.Layout(("id", "title", "message"), (f"{tmp_path}/m/a.csv", f"{tmp_path}/m/b.csv"))
        blocks = landing._lines(spark, layout.paths).select("file", "block").distinct().count()
        found = landing.read_layout(spark, layout, multiline=True)
        assert found.schema.names == schema.names
        got = rows(found)
    finally:
        spark.conf.set(key, before)
    assert blocks == 4
    assert got == rows(one_task)


def test_changed_splits_are_refused(spark, tmp_path):
    _drop(tmp_path / "m", "a.csv", "id,title\n" + 'x,"a\nb"\n' * 200)
    found = landing.records(spark, [f"{tmp_path}/m/a.csv"])
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "500")
    try:
        with pytest.raises(PySparkException):
            found.select("record").collect()
    finally:
        spark.conf.set(key, before)


def test_small_splits_share_tasks(spark, tmp_path):
    """Neither the tasks nor what each of them unpacks grows with the number of splits."""
    records = [f'r{n},"line 1 of {n}\nline 2"' for n in range(4000)]
    _drop(tmp_path / "s", "a.csv", "id,text\n" + "\n".join(records) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        found = landing.records(spark, [f"{tmp_path}/s/a.csv"])
        assert sorted(r.record for r in found.collect()) == sorted(records)
        tasks = spark.sparkContext.defaultParallelism
        assert found.rdd.getNumPartitions() <= tasks + int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_fields_are_rescued_one_by_one(spark, tmp_path):
    _drop(tmp_path / "r", "a.csv", "id,n,at\nx,1,2018-01-01\ny,oops,2018-01-02\nz,many,never\nw,,\nv,5\n")
    (layout,) = landing.layouts(spark, [f"{tmp_path}/r/a.csv"])
    df = landing.rescue_fields(landing.read_layout(spark, layout, with_path=True), {"n": "int", "at": "date"})
    assert df.dtypes == [("id", "string"), ("n", "int"), ("at", "date"), (files.RESCUED, "string")]
    got = {r.id: (r.n, str(r["at"]), json.loads(r[files.RESCUED] or "null")) for r in df.collect()}
    path = f"file:{tmp_path}/r/a.csv"
    assert got["x"] == (1, "2018-01-01", None) and got["w"] == (None, "None", None)
    assert got["y"] == (None, "2018-01-02", {"n": "oops", "_file_path": path})
    assert got["z"] == (None, "None", {"n": "many", "at": "never", "_file_path": path})
    assert got["v"] == (5, "None", {"_record": "v,5", "_file_path": path})


def test_byte_order_mark_is_not_part_of_the_name(spark, tmp_path):
    _drop(tmp_path / "c", "a.csv", "﻿product_category_name,product_category_name_english\nbeleza,beauty\n")
    df = files.csv_table(spark, f"{tmp_path}/c", raw_schema("category_translation"))
    assert rows(df) == [("beleza", "beauty")]


def test_quoted_line_breaks_and_quotes(spark, lake, tmp_path):
    header = ",".join(raw_schema("order_reviews").names) + "\n"
    body = 'r1,o1,5,"a ""good"" one","line 1\nline 2, same field\r\nline 3",2018-01-01,2018-01-02\n'
    _drop(tmp_path / "raw" / "order_reviews", "a.csv", header + body)
    batch.ingest(spark, lake, ["order_reviews"])
    row = batch.bronze(spark, lake, "order_reviews").first()
    assert row.review_comment_title == 'a "good" one'
    assert row.review_comment_message == "line 1\nline 2, same field\r\nline 3"
    assert row.review_answer_timestamp == "2018-01-02"


def test_schema_is_inferred_once_and_drift_reported(spark, tmp_path):
    store = f"{tmp_path}/schema"
    _drop(tmp_path / "d1", "a.csv", "id,n\nx,1\n")
    first = files.resolve_schema(spark, f"{tmp_path}/d1", store)
    assert [f.dataType for f in first.schema.fields] == [StringType(), IntegerType()]
    _drop(tmp_path / "d2", "a.csv", "extra,id\nnew,y\n")
    second = files.resolve_schema(spark, f"{tmp_path}/d2", store)
    assert (second.added, second.missing) == (("extra",), ("n",))
    assert second.schema.names == ["id", "n", "extra"]
    again = files.resolve_schema(spark, f"{tmp_path}/d1", store)
    assert again.schema == second.schema
    late = files.conform(files.csv_table(spark, f"{tmp_path}/d2", second.file_schema), second.schema)
    assert rows(late) == [("y", None, "new")]


def test_rescued_record(spark, tmp_path):
    _drop(tmp_path / "r", "a.csv", "id,n\nx,1\ny,oops\n")
    schema = spark.createDataFrame([], "id string, n int").schema
    df = files.csv_table(spark, f"{tmp_path}/r", schema, rescue=True)
    assert rows(df) == [("x", 1, None), ("y", None, "y,oops")]


def test_one_shot_read_infers_types(spark, tmp_path):
    _drop(tmp_path / "i", "a.csv", "id,n,at\nx,1,2018-01-01 10:00:00\n")
    assert [t for _, t in files.csv_table(spark, f"{tmp_path}/i").dtypes] == ["string", "int", "timestamp"]
