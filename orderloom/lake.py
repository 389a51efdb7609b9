"""Where tables live: one root, one folder per layer, one folder per table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Lake:
    """Path layout of one deployment. ``fmt`` is ``parquet``, or ``delta`` where that jar is present."""

    root: str
    fmt: str = "parquet"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def raw(self, table: str) -> str:
        return self.path("raw", table)

    def bronze(self, table: str) -> str:
        return self.path("bronze", table)

    def silver(self, table: str) -> str:
        return self.path("silver", table)

    def quarantine(self, table: str) -> str:
        return self.path("quarantine", table)

    def gold(self, table: str) -> str:
        return self.path("gold", table)

    def checkpoint(self, stream: str, table: str) -> str:
        return self.path(f"checkpoints/{stream}", table)

    def schema_file(self, table: str) -> str:
        return self.path("checkpoints/schemas", table)


def scratch_root(spark: SparkSession) -> str:
    """A fresh folder every executor can reach: below ``spark.checkpoint.dir``, else below the session's warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{shared.rstrip('/')}/orderloom-{uuid.uuid4().hex}"
