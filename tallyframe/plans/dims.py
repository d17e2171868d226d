"""Dimension lookups shared by the catalogue queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.sources.tables import TableSet


def nation_dim(t: TableSet) -> DataFrame:
    """Nation → region; the nation table has a fixed 25 rows at every scale,
    so broadcasting it is size-safe."""
    return F.broadcast(t.nation.select("n_nationkey", "n_regionkey"))


def region_dim(t: TableSet) -> DataFrame:
    """Fixed 5-row region table (broadcast is size-safe)."""
    return F.broadcast(t.region.select("r_regionkey", "r_name"))


def customer_region(t: TableSet) -> DataFrame:
    """c_custkey → r_regionkey.  The customer table grows with the data, so
    it is joined by shuffle (or by AQE's size-checked broadcast), never hinted."""
    return (t.customer.select("c_custkey", "c_nationkey")
            .join(nation_dim(t), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", F.col("n_regionkey").alias("r_regionkey")))
