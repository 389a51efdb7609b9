"""Times the batch pipeline, its reports and the event cleaners.

``BENCH_SF_DIR`` names the folder of given tables, ``BENCH_CPUS`` the local cores. Prints one JSON line.

Raw CSV folders are written once, untimed. ``build_*`` times the layers of one whole run from CSV to
gold, ``kpi_*`` each report on the gold tables of that run, ``stream_silver_*`` a drained stream from
raw events to a trusted table, ``silver_*`` each cleaner over every row and column it keeps. Every
figure is the median of three runs after one warm-up; only ``build_bronze`` is a single run, the second
of two, because a folder is drained once. ``silver_*`` reads the raw tables of that lake.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from orderloom import Lake, scratch_root, spark_session
from orderloom.plans import batch, gold, kpi, silver
from orderloom.schemas import ENTITIES, EVENT_SCHEMAS, MULTILINE_ENTITIES
from orderloom.sources import events
from orderloom.streaming import silver as stream_silver
from testbed.fixtures import bodies, raw

RUNS = 3


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def median(action) -> float:
    action()
    return statistics.median(timed(action) for _ in range(RUNS))


def noop(df) -> None:
    """Computes every row and column without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def land_raw(spark, sf_dir: str, lake: Lake) -> None:
    options = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    for entity in ENTITIES:
        quoting = {"quote": '"', "escape": '"'} if entity in MULTILINE_ENTITIES else {}
        raw(spark, sf_dir, entity).repartition(8).write.options(**options, **quoting).csv(lake.raw(entity))
    for table in EVENT_SCHEMAS:
        bodies(spark, sf_dir, table).repartition(8).write.parquet(lake.path("stream_bronze", table))


def refine_all(spark, lake: Lake) -> None:
    batch.each(spark, ENTITIES, lambda entity: batch.refine(spark, lake, entity, "bench"))


def publish_all(spark, lake: Lake) -> None:
    batch.each(spark, gold.TABLES, lambda table: batch.publish_gold(spark, lake, table))


def stream(spark, lake: Lake, table: str) -> None:
    target = scratch_root(spark)
    source = events.body_stream(spark, lake.path("stream_bronze", table))
    stream_silver.start_silver(source, table, f"{target}/silver", f"{target}/checkpoint", None).awaitTermination()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = spark_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    # The first lake warms the JVM up; the second is the one measured.
    for _ in range(2):
        lake = Lake(scratch_root(spark))
        land_raw(spark, sf_dir, lake)
        times["build_bronze"] = timed(lambda: batch.ingest(spark, lake))  # noqa: B023
    times["build_silver"] = median(lambda: refine_all(spark, lake))
    times["build_gold"] = median(lambda: publish_all(spark, lake))
    for entity in ENTITIES:
        times[f"silver_{entity}"] = median(lambda e=entity: noop(silver.clean(batch.bronze(spark, lake, e), e).valid))
    for name in kpi.REPORTS:
        times[name] = median(lambda n=name: noop(batch.report(spark, lake, n)))
    for table in EVENT_SCHEMAS:
        times[f"stream_silver_{table}"] = median(lambda t=table: stream(spark, lake, t))

    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in times.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "shuffle_partitions": int(cpus),
                "driver_memory": "16g",
            }
        )
    )


if __name__ == "__main__":
    main()
