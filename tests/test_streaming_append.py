"""The streamed validated append on replays of the orders, against the batch queries."""

import datetime as dt
import random
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from fixtures import rows
from pyspark.sql import functions as F

from tallyframe.operators.append import appended, manifests, read_batches
from tallyframe.plans.catalogue import runner
from tallyframe.streaming.append import append_verdicts, dropped_late, validated_stream
from tallyframe.streaming.balances import start

SF = "/root/testdata/sf0.001"
RUN = uuid.uuid4().hex  # the shared folder may hold the streams of an earlier run


def _land(folder, name, table, keep):
    folder.mkdir(exist_ok=True)
    pq.write_table(pa.Table.from_pylist(keep, table.schema), folder / name)


def _start(spark, tmp_path, name, candidate, check):
    schema = spark.read.parquet(f"{SF}/orders.parquet").schema
    read = lambda side: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / side))
    at = F.col("o_orderdate").cast("timestamp")
    asked = read("candidates").select(*candidate, at.alias("asked_at"))
    known = read("parents").select(F.col("o_orderkey").alias("order_id"), "o_orderstatus", F.col("o_custkey").alias("customer_id"), at.alias("known_at"))
    verdicts = validated_stream(asked, known, "order_id", "asked_at", "known_at", F.col("o_orderstatus") == "F", window="40 days",
                                lateness="60 days", carry_cols=["customer_id"], checks={"rating out of range": check})
    q = start(verdicts, name, "append", append_verdicts(str(tmp_path / "ratings"), "replay"), run_id=RUN)
    q.processAllAvailable()
    q.stop()
    assert q.exception() is None
    return q


def _replay(spark, tmp_path, name, candidate):
    """Orders come as parents and as candidates in batches that differ; the query stops and goes on in between."""
    table = pq.read_table(f"{SF}/orders.parquet")
    r = random.Random(name)
    jitter = lambda: sorted(table.to_pylist(), key=lambda x: x["o_orderdate"] + dt.timedelta(days=r.randint(-25, 25)))
    late = {**table.slice(0, 1).to_pylist()[0], "o_orderkey": -7, "o_orderdate": max(x["o_orderdate"] for x in table.to_pylist()) + dt.timedelta(days=900)}
    sides = {"candidates": jitter(), "parents": jitter()}
    check = F.col("rating").between(1, 5)
    for i in range(4):
        for side, all_rows in sides.items():
            _land(tmp_path / side, f"p{i}.parquet", table, all_rows[len(all_rows) * i // 4 : len(all_rows) * (i + 1) // 4])
        if i == 1:
            _start(spark, tmp_path, name, candidate, check)
    for k in (1, 2):  # rows of a far day move the watermark past all others
        for side in sides:
            _land(tmp_path / side, f"z{k}.parquet", table, [{**late, "o_orderdate": late["o_orderdate"] + dt.timedelta(days=900 * k)}])
    q = _start(spark, tmp_path, name, candidate, check)
    assert len(manifests(spark, str(tmp_path / "ratings"))) > 4 and sum(dropped_late(q).values()) == 0
    return str(tmp_path / "ratings")


def test_accepted_rows_equal_the_batch_query(spark, tmp_path):
    rating = F.floor(F.col("o_totalprice") / 80000).cast("int")
    target = _replay(spark, tmp_path, "accepted_replay", [F.col("o_orderkey").alias("order_id"), rating.alias("rating")])
    got = appended(spark, target).where("order_id >= 0").select("order_id", "customer_id", "rating")
    assert rows(got) == rows(runner("validated_ratings")(spark, SF)) and got.count() > 100


def test_rejected_rows_equal_the_batch_query(spark, tmp_path):
    key = F.col("o_orderkey")
    candidate = [(key + key % 3 * 1_000_000_000).alias("order_id"), (key % 7).cast("int").alias("rating")]
    target = _replay(spark, tmp_path, "rejected_replay", candidate)
    got = read_batches(spark, target, "rejected").where("order_id >= 0").select("order_id", "rating", "reject_reason")
    want = rows(runner("rejected_ratings")(spark, SF))
    assert rows(got) == want and len({r[2] for r in want}) == 3


def test_late_rows_are_counted(spark, tmp_path):
    table = pq.read_table(f"{SF}/orders.parquet")
    model = table.slice(0, 1).to_pylist()[0]
    row = lambda k, day: {**model, "o_orderkey": k, "o_orderstatus": "F", "o_totalprice": 100000.0, "o_orderdate": dt.datetime.fromisoformat(day)}
    candidate = [F.col("o_orderkey").alias("order_id"), F.floor(F.col("o_totalprice") / 80000).cast("int").alias("rating")]
    batches = [([row(1, "1995-01-01")], [row(1, "1995-01-02")]), ([row(2, "1996-01-01")], [row(2, "1996-01-01")]),
               ([row(3, "1995-02-01"), row(4, "1996-01-02")], [row(4, "1996-01-02"), row(5, "1995-01-03")])]
    dropped = 0
    for i, (asked, known) in enumerate(batches):
        _land(tmp_path / "candidates", f"p{i}.parquet", table, asked)
        _land(tmp_path / "parents", f"p{i}.parquet", table, known)
        dropped += sum(dropped_late(_start(spark, tmp_path, "late_replay", candidate, F.lit(True))).values())
    assert dropped == 2
    assert rows(appended(spark, str(tmp_path / "ratings")), "order_id") == [(1,), (2,), (4,)]
