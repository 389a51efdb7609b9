"""Session defaults. Callers that already own a session can ignore this module."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a reduce partition that one hot join key has blown up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keeps the skew split even where it costs a further exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Recording a call site for every column expression costs the driver more than planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def spark_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Build or fetch a session with :data:`DEFAULTS`, then ``conf`` on top.

    ``conf`` keys are written with ``__`` for ``.`` so they can be keyword arguments.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
