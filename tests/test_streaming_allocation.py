"""The keyed-state allocation on replays of the orders, against the batch query."""

import datetime as dt
import random
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyframe.operators.ledger import allocation_of_peaks, month_peaks
from tallyframe.plans.catalogue import runner
from tallyframe.streaming.allocation import month_peaks_stream
from tallyframe.streaming.append import dropped_late
from tallyframe.streaming.balances import ledger_stream, start

SF = "/root/testdata/sf0.001"
RUN = uuid.uuid4().hex  # the shared folder may hold the streams of an earlier run
SIGNS = {"F": 1, "O": -1, "P": -1}


def _peaks(spark, land, lateness):
    schema = spark.read.parquet(f"{SF}/orders.parquet").schema
    s = ledger_stream(spark, str(land), schema, account="o_custkey", when="o_orderdate", kind="o_orderstatus",
                      amount="o_totalprice", signs=SIGNS, max_files_per_trigger=1)
    return month_peaks_stream(s.withColumn("net", F.round(F.col("net") * 100).cast("long")), lateness)


def _run(spark, land, out, name, lateness):
    q = start(_peaks(spark, land, lateness), name, "append", "parquet", {"path": str(out)}, run_id=RUN)
    q.processAllAvailable()
    q.stop()
    assert q.exception() is None
    return sum(dropped_late(q).values())


def _orders(table, rows):
    return pa.Table.from_pylist(rows, table.schema)


def test_replay_in_shuffled_batches_with_a_restart(spark, tmp_path):
    table = pq.read_table(f"{SF}/orders.parquet")
    r = random.Random(2)
    # each row comes up to 50 days early or late, so that every batch holds rows of several months in no order
    rows = sorted(table.to_pylist(), key=lambda x: x["o_orderdate"] + dt.timedelta(days=r.randint(-50, 50)))
    land, out = tmp_path / "landing", tmp_path / "out"
    land.mkdir()
    n = 7
    for i in range(n):
        part = rows[len(rows) * i // n : len(rows) * (i + 1) // n]
        r.shuffle(part)
        pq.write_table(_orders(table, part), land / f"p{i}.parquet")
        if i in (2, 4):
            _run(spark, land, out, "peaks_replay", "200 days")  # stopped and started again with the same state
    last = max(x["o_orderdate"] for x in rows)
    pq.write_table(_orders(table, [{**rows[0], "o_custkey": -1, "o_totalprice": 0.0, "o_orderdate": last + dt.timedelta(days=400)}]), land / "p9.parquet")
    assert _run(spark, land, out, "peaks_replay", "200 days") == 0
    got = spark.read.parquet(str(out))
    assert got.count() == got.select("account", "month").distinct().count()
    allocation = allocation_of_peaks(got, F.lit(last).cast("date"))
    want = {x["month"]: x["allocation"] for x in runner("allocation_realtime")(spark, SF).collect()}
    assert {x["month"]: float(x["allocation"]) / 100 for x in allocation.collect()} == pytest.approx(want) and want


def test_late_rows_are_counted_and_change_nothing(spark, tmp_path):
    table = pq.read_table(f"{SF}/orders.parquet")
    model = table.slice(0, 1).to_pylist()[0]
    day = lambda s: dt.datetime.fromisoformat(s)
    row = lambda account, when, price, status="F": {**model, "o_custkey": account, "o_orderdate": when and day(when),
                                                    "o_totalprice": price, "o_orderstatus": status}
    batches = [
        [row(1, "1995-01-10", 5.0), row(1, "1995-01-20", 7.0, "O"), row(2, "1995-01-31", 1.0), row(None, "1995-01-02", 4.0), row(1, None, 9.0)],
        [row(1, "1995-03-20", 3.0)],
        [row(1, "1995-01-11", 50.0), row(1, "1995-01-12", 25.0), row(3, "1995-02-01", 1.0), row(1, "1995-03-02", 4.0)],
        [row(9, "1996-01-01", 0.0)],
    ]
    land, out = tmp_path / "landing", tmp_path / "out"
    land.mkdir()
    late = 0
    for i, batch in enumerate(batches):
        pq.write_table(_orders(table, batch), land / f"p{i}.parquet")
        late += _run(spark, land, out, "peaks_late", "5 days")
    assert late == 4  # of the third batch, all behind 15 March
    got = spark.read.parquet(str(out)).collect()
    # account 1 closes January at -2, March at 1
    assert sorted((x["account"] or 0, x["month"].month, x["change"], x["extra"], x["n_days"]) for x in got) == [
        (0, 1, 400, 400, 1), (1, 1, 0, 500, 2), (1, 3, 100, 100, 1), (2, 1, 100, 100, 1)]


def test_batch_form_of_the_peaks(spark):
    rows = [(1, dt.date(2020, 1, 5), 10), (1, dt.date(2020, 1, 9), -30), (1, dt.date(2020, 4, 1), 50), (2, dt.date(2020, 2, 1), 7)]
    df = spark.createDataFrame(rows, "c int, d date, amt long")
    got = {x["month"].month: int(x["allocation"]) for x in
           allocation_of_peaks(month_peaks(df, "c", "d", "amt"), F.lit(dt.date(2020, 5, 3))).collect()}
    assert got == {1: 10, 2: 7, 3: 7, 4: 37, 5: 37}
