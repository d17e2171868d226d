import datetime as dt

from pyspark.sql import functions as F

from tallyframe.functions import (counted_label, day_of_week_sun1, id_list, is_present, number_in_text,
                                  optional_part, week_of_year_sun0, whole_minutes, words)
from tallyframe.operators.aggs import arg_max_ties, mean_half_up, ordered_list, percent_half_up, share_of_total
from tallyframe.operators.joins import full_outer_merge, member_join


def test_text_helpers(spark):
    df = spark.createDataFrame([("1, 5",), ("",), (None,), ("2,2, 3",), ("23.4 km",), ("1.2.3",), ("x",)], "s string")
    got = df.select(is_present("s").alias("p"), id_list("s").alias("ids"), number_in_text("s").alias("n")).collect()
    assert [r["p"] for r in got] == [True, False, False, True, True, True, True]
    assert [r["ids"] for r in got][:4] == [["1", "5"], [], [], ["2", "3"]]
    assert [r["n"] for r in got][4:] == [23.4, None, None]


def test_words_and_labels(spark):
    df = spark.createDataFrame([("  small  ring ", 2, "x"), (None, 1, None)], "t string, n int, v string")
    got = df.select(words("t").alias("w"), counted_label("n", F.lit("Bacon")).alias("l"),
                    optional_part(" - Extra ", "v").alias("o")).collect()
    assert got[0]["w"] == ["small", "ring"] and got[1]["w"] == []
    assert [r["l"] for r in got] == ["2xBacon", "Bacon"]
    assert [r["o"] for r in got] == [" - Extra x", ""]


def test_calendar(spark):
    days = [dt.date(2021, 1, 1), dt.date(2021, 1, 3), dt.date(2021, 1, 8), dt.date(2021, 1, 15), dt.date(2020, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(week_of_year_sun0("d").alias("w"), day_of_week_sun1("d").alias("dow")).collect()
    assert [r["w"] for r in got] == [0, 1, 1, 2, 52]
    assert [r["dow"] for r in got] == [6, 1, 6, 6, 5]
    ts = spark.createDataFrame([(dt.datetime(2020, 1, 1, 18, 5, 2), dt.datetime(2020, 1, 1, 18, 15, 1))], "a timestamp, b timestamp")
    assert ts.select(whole_minutes("a", "b")).first()[0] == 9


def test_rounding_helpers(spark):
    df = spark.createDataFrame([(1, 8, 125, 1000, -125)], "a long, b long, c long, d long, e long")
    r = df.select(percent_half_up(F.col("a"), F.col("b"), 1).alias("p"),
                  mean_half_up(F.col("c"), F.col("d"), 2).alias("m"),
                  mean_half_up(F.col("e"), F.col("d"), 2).alias("neg")).first()
    assert r["p"] == 12.5 and r["m"] == 0.13 and r["neg"] == -0.13


def test_shares_ties_lists_and_joins(spark):
    counts = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1)], "k string, n long")
    assert sorted(r["k"] for r in arg_max_ties(counts, "n").collect()) == ["a", "b"]
    assert {r["k"]: r["pct"] for r in share_of_total(counts, "n", "pct").collect()} == {"a": 40.0, "b": 40.0, "c": 20.0}
    items = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "z", 0)], "g int, item string, o int")
    assert sorted(tuple(r) for r in ordered_list(items, "g", "item", "o").collect()) == [(1, "a,b"), (2, "z")]
    left = spark.createDataFrame([(1, "x")], "k int, l string")
    right = spark.createDataFrame([(2, "y")], "k int, r string")
    assert sorted(tuple(r) for r in full_outer_merge(left, right, "k").collect()) == [(1, "x", None), (2, None, "y")]
    dim = spark.createDataFrame([(1, "Bacon"), (5, "Chicken")], "topping_id int, topping_name string")
    rows = spark.createDataFrame([(9, "1, 5, 1"), (10, ""), (11, None)], "o int, extras string")
    got = sorted((r["o"], r["topping_name"]) for r in member_join(rows, "extras", dim, "topping_id").collect())
    assert got == [(9, "Bacon"), (9, "Chicken")]


def test_tableset_from_catalog_and_views(spark):
    from tallyframe.sources.tables import TableSet
    t = TableSet(spark, "/root/testdata/sf0.001")
    t.register_views()
    assert spark.sql("SELECT COUNT(*) FROM region").first()[0] == 5
    spark.sql("CREATE DATABASE IF NOT EXISTS tf_test_db")
    t.region.write.mode("overwrite").saveAsTable("tf_test_db.region")
    assert TableSet(spark, database="tf_test_db").region.count() == 5


def test_empty_and_zero_inputs(spark):
    df = spark.createDataFrame([(0, 0, 5)], "n long, d long, t long")
    r = df.select(percent_half_up(F.col("n"), F.col("d")).alias("p"), mean_half_up(F.col("t"), F.col("d")).alias("m")).first()
    assert r["p"] is None and r["m"] is None
    from tallyframe.operators.ledger import month_end_balances
    txns = spark.createDataFrame([(1, dt.date(2020, 5, 2), 10)], "c int, d date, amt long")
    assert month_end_balances(txns, "c", "d", "amt", F.lit(dt.date(2020, 3, 1))).count() == 0


def test_scale_conf_sizes_partitions():
    from tallyframe.session import scale_conf
    c = scale_conf(10 << 40, 4000)                      # 10 TB on 4000 cores
    assert int(c["spark.sql.shuffle.partitions"]) == 40960
    assert c["spark.sql.files.maxPartitionBytes"] == "256m"
    assert int(scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 16
    assert int(scale_conf(100 << 40, 8000)["spark.sql.shuffle.partitions"]) == 409_600   # no cap
