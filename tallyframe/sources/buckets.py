"""Bucketed catalog tables: written once by the key they are joined on, read by qualified name without an exchange."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyframe.session import shared_folder


def bucketed_database(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, str | None]], buckets: int) -> str:
    """Write ``name -> (rows, key)`` as tables of a new database and return its name.

    Rows with a key are dealt into ``buckets`` by its hash and sorted by it, one file a bucket, so that tables bucketed
    alike join and group on it where they lie; a key of None writes a plain table.  The database stands in a folder of
    its own under the shared folder and goes with the application.
    """
    name = f"tallyframe_{uuid.uuid4().hex}"
    folder = shared_folder(spark, name)
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    for table, (rows, key) in tables.items():
        writer = rows.write if key is None else rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(f"{name}.{table}")
    return name
