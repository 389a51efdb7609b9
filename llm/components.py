"""Connected components of a graph in a table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import passing, written


def components(links: DataFrame) -> DataFrame:
    """node, component (its least member) of each node in links (a, b); either way around, repeats and loops allowed.

    Each half round hangs a node's neighbours on their least one. Smallest members are found by aggregates that
    combine before the shuffle, and are written before they are joined; so both sides of each join are plain scans,
    and adaptive execution can split a node that a third of all links share.
    """
    spark = links.sparkSession
    links = written(links.filter("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct(), "links")
    before = None
    while True:
        with passing(spark) as keep:
            both = links.union(links.selectExpr("b as a", "a as b"))
            least = written(both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a as n", "least(a, m) as m"), "least")
            large = written(both.filter("b > a").join(least, F.col("a") == F.col("n")).selectExpr("b as a", "m as b").filter("a <> b").distinct(), "large")
            least = written(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n"), "least")
            small = large.join(least, F.col("a") == F.col("n")).selectExpr("b as a", "m as b").union(least.selectExpr("n as a", "m as b"))
            links = keep(written(small.filter("a <> b").distinct(), "small"))
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return links.selectExpr("a as node", "b as component").union(links.selectExpr("b as node", "b as component").distinct())
        before = now


def joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """labels (each node's least known companion) after a and b are linked, pair by pair; within one task."""
    while True:
        one, two = labels[a], labels[b]
        differ = one != two
        if not differ.any():
            return labels
        a, b, one, two = a[differ], b[differ], one[differ], two[differ]
        np.minimum.at(labels, np.maximum(one, two), np.minimum(one, two))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up
