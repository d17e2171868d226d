"""Reading the analysis tables.

Tables are parquet folders/files named after the table.  Reads are lazy;
Catalyst pushes filters and the column projection of each query into the
parquet scan (``PushedFilters`` / ``ReadSchema`` in the plan), so a query
reads only the columns it uses.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Table names of a data folder.
TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Declared schemas of the analysis tables.  Reading with a declared schema
# skips the footer-reading job of schema inference and pins the column types
# the queries are written against.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    path = os.path.join(data_dir, f"{name}.parquet")
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(path)


class TableSet:
    """Lazy accessor ``tables.orders`` → DataFrame over ``<dir>/orders.parquet``,
    or over the catalog table ``<database>.orders`` when ``database`` is given
    (schema-qualified tables registered in a metastore)."""

    def __init__(self, spark: SparkSession, data_dir: str | None = None, database: str | None = None):
        if (data_dir is None) == (database is None):
            raise ValueError("give exactly one of data_dir and database")
        self.spark = spark
        self.data_dir = data_dir
        self.database = database
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._cache:
            if self.database is not None:
                self._cache[name] = self.spark.table(f"{self.database}.{name}")
            else:
                self._cache[name] = read_table(self.spark, self.data_dir, name)
        return self._cache[name]

    def register_views(self) -> None:
        """Temp views for the SQL API (``spark.sql("SELECT … FROM orders")``)."""
        for name in TABLE_NAMES:
            if self.database is not None or os.path.exists(os.path.join(self.data_dir, f"{name}.parquet")):
                getattr(self, name).createOrReplaceTempView(name)
