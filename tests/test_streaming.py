import shutil
import uuid

import pytest

from tallyframe.streaming.balances import daily_net_stream, ledger_stream, live_balances, start

SF = "/root/testdata/sf0.001"
RUN = uuid.uuid4().hex  # the shared folder may hold the streams of an earlier run


@pytest.fixture(scope="module")
def stream_dir(tmp_path_factory):
    """A landing folder holding the orders file (a file stream reads folders)."""
    d = tmp_path_factory.mktemp("orders_landing")
    shutil.copy(f"{SF}/orders.parquet", d / "part-00000.parquet")
    return str(d)


def _stream(spark, path):
    schema = spark.read.parquet(f"{SF}/orders.parquet").schema
    s = ledger_stream(spark, path, schema, account="o_custkey", when="o_orderdate",
                      kind="o_orderstatus", amount="o_totalprice", signs={"F": 1, "O": -1, "P": -1})
    return s


def test_live_balances_match_batch(spark, stream_dir):
    q = start(live_balances(_stream(spark, stream_dir)), "live_balances_test", "update", "memory")
    try:
        q.processAllAvailable()
        got = {r["account"]: round(r["balance"], 2) for r in spark.sql("select * from live_balances_test").collect()}
    finally:
        q.stop()
    from pyspark.sql import functions as F
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    sign = F.when(F.col("o_orderstatus") == "F", 1).otherwise(-1)
    exp = {r[0]: round(r[1], 2) for r in orders.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice") * sign)).collect()}
    assert got.keys() == exp.keys()
    assert all(got[k] == pytest.approx(exp[k], abs=0.02) for k in exp)


def test_daily_net_append(spark, stream_dir):
    q = start(daily_net_stream(_stream(spark, stream_dir)), "daily_net_test", "append", "memory")
    try:
        q.processAllAvailable()
        n = spark.sql("select count(*) from daily_net_test").collect()[0][0]
    finally:
        q.stop()
    # Only days whose end is behind the watermark (newest day minus two) are final.
    from pyspark.sql import functions as F
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    final = F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS") <= F.lit(orders.agg(F.max("o_orderdate")).first()[0])
    assert n == orders.where(final).select("o_custkey", "o_orderdate").distinct().count() > 0


def test_daily_net_matches_batch_after_watermark(spark, tmp_path):
    """Two files arrive in two triggers; days behind the watermark are final
    and equal to the batch daily net."""
    import pyarrow.parquet as pq
    import pyarrow.compute as pc
    tbl = pq.read_table(f"{SF}/orders.parquet")
    cut = pc.less(tbl["o_orderdate"], pc.cast("1998-01-01", tbl["o_orderdate"].type))
    land = tmp_path / "landing"
    land.mkdir()
    pq.write_table(tbl.filter(cut), land / "part-0.parquet")
    schema = spark.read.parquet(f"{SF}/orders.parquet").schema
    s = ledger_stream(spark, str(land), schema, account="o_custkey", when="o_orderdate",
                      kind="o_orderstatus", amount="o_totalprice", signs={"F": 1, "O": -1, "P": -1})
    q = start(daily_net_stream(s, "1 day"), "daily_net_two", "append", "memory")
    try:
        q.processAllAvailable()
        pq.write_table(tbl.filter(pc.invert(cut)), land / "part-1.parquet")
        q.processAllAvailable()
        got = {(r["account"], r["day"]["start"].date()): round(r["daily_net"], 2)
               for r in spark.sql("select * from daily_net_two").collect()}
    finally:
        q.stop()
    from pyspark.sql import functions as F
    o = spark.read.parquet(f"{SF}/orders.parquet").where(F.col("o_orderdate") < "1998-01-01")
    sign = F.when(F.col("o_orderstatus") == "F", 1).otherwise(-1)
    exp = {(r[0], r[1]): round(r[2], 2) for r in
           o.groupBy("o_custkey", F.to_date("o_orderdate")).agg(F.sum(F.col("o_totalprice") * sign)).collect()}
    assert exp and all(got.get(k) == pytest.approx(v, abs=0.02) for k, v in exp.items())


def test_daily_net_restarts_from_checkpoint(spark, tmp_path):
    """A stopped query restarts from its checkpoint: the parquet sink ends up
    with every final day exactly once."""
    import pyarrow.compute as pc
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F
    tbl = pq.read_table(f"{SF}/orders.parquet")
    d = tbl["o_orderdate"]
    parts = [pc.less(d, pc.cast("1996-01-01", d.type)),
             pc.and_(pc.greater_equal(d, pc.cast("1996-01-01", d.type)), pc.less(d, pc.cast("1997-01-01", d.type))),
             pc.greater_equal(d, pc.cast("1997-01-01", d.type))]
    land, out = tmp_path / "landing", tmp_path / "out"
    land.mkdir()
    schema = spark.read.parquet(f"{SF}/orders.parquet").schema

    def run(name_suffix):
        s = ledger_stream(spark, str(land), schema, account="o_custkey", when="o_orderdate",
                          kind="o_orderstatus", amount="o_totalprice", signs={"F": 1, "O": -1, "P": -1})
        q = start(daily_net_stream(s, "1 day").select("account", F.col("day.start").alias("day"), "daily_net"),
                  "daily_net_restart", "append", "parquet", {"path": str(out)}, run_id=RUN)
        q.processAllAvailable()
        return q

    pq.write_table(tbl.filter(parts[0]), land / "p0.parquet")
    run("a").stop()                                  # stopped (as if the driver failed)
    pq.write_table(tbl.filter(parts[1]), land / "p1.parquet")
    pq.write_table(tbl.filter(parts[2]), land / "p2.parquet")
    q = run("b")                                     # same checkpoint: resumes
    q.stop()
    got = spark.read.parquet(str(out))
    assert got.count() == got.select("account", "day").distinct().count()   # no day twice
    cutoff = spark.read.parquet(str(out)).agg(F.max("day")).first()[0]
    orders = spark.read.parquet(f"{SF}/orders.parquet").where(F.col("o_orderdate") <= cutoff)
    exp = orders.select("o_custkey", "o_orderdate").distinct().count()
    assert got.count() == exp


def test_live_balances_snapshots_survive_a_restart(spark, tmp_path):
    import pyarrow.compute as pc
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from tallyframe.streaming.balances import snapshots
    tbl = pq.read_table(f"{SF}/orders.parquet")
    first = pc.less(tbl["o_orderdate"], pc.cast("1996-01-01", tbl["o_orderdate"].type))
    land, out = tmp_path / "landing", str(tmp_path / "out")
    land.mkdir()
    schema = spark.read.parquet(f"{SF}/orders.parquet").schema
    for i, part in enumerate((first, pc.invert(first))):
        pq.write_table(tbl.filter(part), land / f"p{i}.parquet")
        s = ledger_stream(spark, str(land), schema, account="o_custkey", when="o_orderdate",
                          kind="o_orderstatus", amount="o_totalprice", signs={"F": 1, "O": -1, "P": -1})
        q = start(live_balances(s), "balance_snapshots", "update", snapshots(out, "account"), run_id=RUN)
        q.processAllAvailable()
        q.stop()
    got = {r["account"]: r["n_txn"] for r in spark.read.parquet(f"{out}/1").collect()}
    want = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/orders.parquet").groupBy("o_custkey").agg(F.count("*")).collect()}
    assert got == want


def test_snapshots_refuse_the_tables_of_another_run(spark, tmp_path):
    from tallyframe.streaming.balances import snapshots
    out = str(tmp_path / "out")
    table = lambda k: spark.createDataFrame([(k, 1)], "account int, n int")
    sink = snapshots(out, "account")
    for number in range(4):
        sink(table(number), number)
    sink(table(3), 3)  # a batch that runs again
    assert sorted(r["account"] for r in spark.read.parquet(f"{out}/3").collect()) == [0, 1, 2, 3]
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["2", "3"]
    with pytest.raises(ValueError):
        snapshots(out, "account")(table(9), 0)
