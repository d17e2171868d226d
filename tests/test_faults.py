"""Inputs that once gave wrong answers: NULL keys and dates, ties, decimals, totals beyond a long's multiples."""

import datetime as dt
import random
from types import SimpleNamespace

import pytest
from fixtures import rows
from pyspark.sql import functions as F

from tallyframe.operators.aggs import _int_div, mean_half_up, percent_half_up, rank_percentiles
from tallyframe.operators.append import validate_candidates
from tallyframe.operators.ledger import month_end_balances
from tallyframe.plans.delivery_queries import fulfilment_rate_per_supplier
from tallyframe.plans.subscription_queries import errored_never_purchased


def test_integer_division_is_exact(spark):
    r = random.Random(3)
    pairs = [(r.randrange(2**63), r.randrange(1, 2**20)) for _ in range(2000)] + [(81528662993726669, 121809)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", _int_div(F.col("a"), F.col("b")).alias("q")).collect()
    assert all(x["q"] == x["a"] // x["b"] for x in got)


def test_means_of_huge_totals(spark):
    totals = [10**18, 10**18 + 5, -(10**18) - 7, 10**19]
    df = spark.createDataFrame([(str(t),) for t in totals], "t string").select(F.col("t").cast("decimal(30,0)").alias("t"))
    for x in df.select("t", mean_half_up(F.col("t"), F.lit(300_000), 4).alias("m")).collect():
        t = int(x["t"])
        want = (abs(t) * 20000 + 300_000) // 600_000 / 10000
        assert x["m"] == pytest.approx(want if t > 0 else -want, rel=1e-15)
    n = spark.range(1).select(percent_half_up(F.lit(10**17), F.lit(3 * 10**17), 1).alias("p")).first()["p"]
    assert n == 33.3


def test_percentiles_of_decimals(spark):
    df = spark.range(1, 201).select(F.lit("g").alias("g"), (F.col("id") / 100).cast("decimal(10,2)").alias("v"))
    out = rank_percentiles(df, "g", "v", {"median": 0.5, "p80": 0.8}).first()
    assert (out["median"], out["p80"]) == (1.0, 1.6)


def test_percentiles_refuse_what_has_no_mean(spark):
    with pytest.raises(ValueError):
        rank_percentiles(spark.createDataFrame([("g", "1")], "g string, v string"), "g", "v", {"median": 0.5})


def test_null_dates_belong_to_no_month(spark):
    txns = spark.createDataFrame([(1, dt.date(2020, 1, 5), 10), (1, None, 99), (2, None, 5)], "c int, d date, amt long")
    out = month_end_balances(txns, "c", "d", "amt", F.lit(dt.date(2020, 2, 1)))
    assert rows(out, "c", "month", "closing_balance") == [(1, dt.date(2020, 1, 1), 10), (1, dt.date(2020, 2, 1), 10)]


def test_ties_between_eligible_parents_go_by_the_carried_values(spark):
    parents = [(1, 10, True), (1, 11, True), (1, 12, False)]
    cands = spark.createDataFrame([(1,)], "order_id int")
    for order in (parents, parents[::-1]):
        p = spark.createDataFrame(order, "order_id int, runner_id int, ok boolean").repartition(3)
        out = validate_candidates(cands, p, "order_id", F.col("ok"), carry_cols=["runner_id"])
        assert rows(out, "runner_id", "reject_reason") == [(11, None)]


def test_a_null_user_is_nobody(spark):
    events = spark.createDataFrame([(1, "error"), (None, "error"), (None, "purchase"), (2, "purchase")], "user_id long, event_type string")
    assert rows(errored_never_purchased(SimpleNamespace(events=events))) == [(2, 100.0)]


def test_a_null_supplier_has_no_rate(spark):
    lines = spark.createDataFrame([(1, "F"), (1, "O"), (None, "F")], "l_suppkey long, l_linestatus string")
    assert rows(fulfilment_rate_per_supplier(SimpleNamespace(lineitem=lines))) == [(1, 50.0)]


def test_no_output_partition_holds_a_fifth_of_the_orders(spark):
    from tallyframe.plans.catalogue import runner

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        out = runner("basket_size_vs_lead_time")(spark, "/root/testdata/sf0.01")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 2 * sum(sizes) / 32


def test_local_checkpoint_folder_is_for_local_masters_only(monkeypatch):
    from tallyframe.session import checkpoint_dir

    conf = SimpleNamespace(get=lambda *a: None)
    fake = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn", getConf=lambda: conf))
    with pytest.raises(RuntimeError):
        checkpoint_dir(fake)
