"""Real-time balances with Structured Streaming.

``live_balances``: the current balance per account, a stateful aggregation
keyed by account (state = one running sum per account), emitted in update
mode.  ``daily_net_stream``: per account and day, event-time windows with a
watermark, emitted in append mode once a day can no longer change; late rows
beyond the watermark are dropped by Spark, as for any windowed aggregate, and
counted (``streaming.append.dropped_late``).
Both are partitioned by the account key across the state store, and
checkpointed to the shared checkpoint folder for recovery after failures.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.operators.ledger import signed_amount
from tallyframe.session import checkpoint_dir


def ledger_stream(spark: SparkSession, path: str, schema: StructType | str, *, account: str, when: str,
                  kind: str, amount: str, signs: dict[str, int], max_files_per_trigger: int | None = None) -> DataFrame:
    """Read a folder of parquet ledger files as a stream of signed amounts:
    columns (account, ts, net)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(path)
    return raw.select(F.col(account).alias("account"), F.col(when).cast("timestamp").alias("ts"),
                      signed_amount(kind, amount, signs).alias("net"))


def live_balances(stream: DataFrame) -> DataFrame:
    """Current balance, transaction count and last activity per account."""
    return stream.groupBy("account").agg(F.sum("net").alias("balance"), F.count("*").alias("n_txn"),
                                         F.max("ts").alias("last_ts"))


def daily_net_stream(stream: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Net amount per account and day, final once the watermark passes the day."""
    return (stream.withWatermark("ts", lateness)
            .groupBy("account", F.window("ts", "1 day").alias("day"))
            .agg(F.sum("net").alias("daily_net")))


def snapshots(path: str, keys) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink for update mode: each batch writes the table of latest rows per key to ``path/<batch>``
    and takes away the last but one before it.

    A batch that runs again after a failure reads the same predecessor and overwrites its own folder, so the result is
    as if it had run once.  The first batch of a new checkpoint refuses a folder that already holds tables: it would
    start an empty table over them.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)

    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        latest = batch
        if number > 0:
            before = spark.read.parquet(f"{path}/{number - 1}")
            latest = before.join(batch, keys, "left_anti").unionByName(batch)
        elif fs.exists(folder) and any(s.getPath().getName() != "0" for s in fs.listStatus(folder)):
            raise ValueError(f"{path} holds the tables of another run, whose checkpoint is not this one's")
        latest.write.mode("overwrite").parquet(f"{path}/{number}")
        if number > 1:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{number - 2}"), True)

    return upsert


def start(query_df: DataFrame, name: str, mode: str, sink: str | Callable[[DataFrame, int], None],
          options: dict[str, str] | None = None, trigger: dict | None = None, run_id: str | None = None):
    """Start a query with its checkpoint under the shared checkpoint folder.

    ``sink`` is a format (with ``options`` such as ``path``) or a
    ``foreachBatch`` function such as :func:`snapshots`; a durable one restarts
    from ``streams/<name>`` after a failure.  The in-memory sink holds all its
    output on the driver and cannot recover: name it for tests only; each of
    its runs gets its own folder.
    """
    spark = query_df.sparkSession
    if sink == "memory" and run_id is None:
        run_id = uuid.uuid4().hex
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name if run_id is None else f"{name}-{run_id}")
    w = query_df.writeStream.outputMode(mode).option("checkpointLocation", ckpt).options(**(options or {}))
    w = w.foreachBatch(sink) if callable(sink) else w.format(sink)
    if sink == "memory":
        w = w.queryName(name)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
