"""Bank analyses over the case study's own layout: regions(region_id,
region_name), customer_nodes(customer_id, region_id, node_id, start_date,
end_date), customer_transactions(customer_id, txn_date, txn_type,
txn_amount)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.aggs import rank_percentiles
from tallyframe.operators.ledger import (balance_segments, daily_net, month_end_balances, running_balance,
                                         signed_amount, window_weighted_sum)
from tallyframe.operators.states import change_gaps

# Transaction types and their signs.
SIGNS = {"deposit": 1, "purchase": -1, "withdrawal": -1}


def unique_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.agg(F.count_distinct("node_id").alias("unique_nodes"))


def nodes_per_region(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    return (nodes.join(regions, "region_id").groupBy("region_id", "region_name")
            .agg(F.count_distinct("node_id").alias("distinct_nodes")))


def customers_per_region(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    return (nodes.join(regions, "region_id").groupBy("region_id", "region_name")
            .agg(F.count_distinct("customer_id").alias("customers")))


def reallocation_gaps(nodes: DataFrame) -> DataFrame:
    """Rows following a node change with the days since the previous row.

    Rows are ordered by start date per customer (split by day, so a
    customer with a very long history is not one task)."""
    return change_gaps(nodes, "customer_id", "start_date", "node_id",
                       split=F.to_date("start_date"), out_col="diff")


def avg_reallocation_days(nodes: DataFrame) -> DataFrame:
    g = reallocation_gaps(nodes)
    return g.agg(F.concat(F.round(F.avg("diff"), 1).cast("decimal(18,1)").cast("string"),
                          F.lit(" days")).alias("average_days_reallocated_node"))


def reallocation_percentiles(nodes: DataFrame) -> DataFrame:
    """Median, 80th and 95th rank percentile of the gap per region."""
    return rank_percentiles(reallocation_gaps(nodes), "region_id", "diff",
                            {"median": "0.5", "percentile_80th": "0.8", "percentile_95th": "0.95"})


def _ledger(txns: DataFrame) -> DataFrame:
    return txns.withColumn("net", signed_amount("txn_type", "txn_amount", SIGNS))


def type_summary(txns: DataFrame) -> DataFrame:
    return txns.groupBy("txn_type").agg(F.count("*").alias("unique_count"), F.sum("txn_amount").alias("total_amount"))


def avg_deposits(txns: DataFrame) -> DataFrame:
    per = (txns.where(F.col("txn_type") == "deposit").groupBy("customer_id")
           .agg(F.count("*").alias("n"), F.sum("txn_amount").alias("amount")))
    return per.agg(F.avg("n").alias("avg_deposit_count"), F.avg("amount").alias("avg_deposit_amount"))


def active_customers_per_month(txns: DataFrame, exactly_one: bool = False) -> DataFrame:
    """Customers per month with >1 deposit and at least one (or exactly one)
    purchase or withdrawal."""
    t = F.col("txn_type")
    per = (txns.groupBy("customer_id", F.trunc("txn_date", "month").alias("month"))
           .agg(F.count_if(t == "deposit").alias("d"), F.count_if(t == "purchase").alias("p"),
                F.count_if(t == "withdrawal").alias("w")))
    other = ((F.col("p") == 1) | (F.col("w") == 1)) if exactly_one else ((F.col("p") >= 1) | (F.col("w") >= 1))
    return per.where((F.col("d") > 1) & other).groupBy("month").agg(F.count("*").alias("customers"))


def _daily(txns: DataFrame) -> DataFrame:
    return daily_net(_ledger(txns), "customer_id", "txn_date", "net")


def _end(txns: DataFrame):
    return F.last_day(txns.agg(F.max("txn_date")).scalar())


def closing_balances(txns: DataFrame) -> DataFrame:
    return month_end_balances(_daily(txns), "customer_id", "txn_date", "daily_net", _end(txns))


def growing_customers_share(txns: DataFrame, growth: float = 0.05) -> DataFrame:
    """Percent of customers whose last closing balance exceeds the first by
    more than ``growth`` (first balance must be positive)."""
    ends = closing_balances(txns).groupBy("customer_id").agg(
        F.min_by("closing_balance", "month").alias("first"), F.max_by("closing_balance", "month").alias("last"))
    grow = (F.col("first") > 0) & (F.col("last") > F.col("first") * (1 + growth))
    return ends.agg(F.count_if(grow).alias("customers"), (F.count_if(grow) * 100.0 / F.count("*")).alias("percentage"))


def running_balances(txns: DataFrame) -> DataFrame:
    return running_balance(_daily(txns), "customer_id", "txn_date", "daily_net")


def running_balance_stats(txns: DataFrame) -> DataFrame:
    return running_balances(txns).groupBy("customer_id").agg(
        F.min("running_balance").alias("min_balance"), F.avg("running_balance").alias("avg_balance"),
        F.max("running_balance").alias("max_balance"))


def data_needed_option1(txns: DataFrame) -> DataFrame:
    """Per month: Σ over customers of last month's closing balance (≥ 0)."""
    w = Window.partitionBy("customer_id").orderBy("month")
    c = closing_balances(txns).withColumn("prev", F.lag("closing_balance").over(w))
    return c.where(F.col("prev").isNotNull()).groupBy("month").agg(
        F.sum(F.greatest("prev", F.lit(0))).alias("data_needed"))


def data_needed_option2(txns: DataFrame) -> DataFrame:
    """Per month: Σ over customers of the mean balance of the last 30 days of the month (≥ 0)."""
    end = _end(txns)
    seg = balance_segments(running_balance(_daily(txns), "customer_id", "txn_date", "daily_net", "balance"),
                           "customer_id", "txn_date", "balance", end)
    month_end = F.least(F.last_day(F.col("month")), end)
    anchors = F.sequence(F.trunc("seg_start", "month"), F.trunc(F.least(F.date_add("seg_end", 29), end), "month"),
                         F.expr("INTERVAL 1 MONTH"))
    w = window_weighted_sum(seg, "customer_id", "balance", F.date_sub(month_end, 29), month_end, anchors)
    return w.groupBy("month").agg((F.sum(F.greatest("balance_days", F.lit(0))) / 30).alias("data_needed"))


def data_needed_option3(txns: DataFrame) -> DataFrame:
    """Per month: Σ over customers of the highest balance reached in the month (≥ 0):
    the opening balance plus the largest running net within the month."""
    daily = _daily(txns).withColumn("_m", F.trunc("txn_date", "month"))
    within = Window.partitionBy("customer_id", "_m").orderBy("txn_date") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    daily = daily.withColumn("_prefix", F.sum("daily_net").over(within))
    spine = month_end_balances(daily, "customer_id", "txn_date", "daily_net", _end(txns),
                               extra_aggs={"max_prefix": F.max("_prefix")})
    opening = F.col("closing_balance") - F.col("month_net")
    top = F.greatest(opening, F.coalesce(opening + F.col("max_prefix"), opening), F.lit(0))
    return spine.groupBy("month").agg(F.sum(top).alias("data_needed"))


def daily_interest_per_month(txns: DataFrame, rate: float = 0.06) -> DataFrame:
    """Per month: simple daily interest (rate/365 of each end-of-day balance)."""
    end = _end(txns)
    seg = balance_segments(running_balance(_daily(txns), "customer_id", "txn_date", "daily_net", "balance"),
                           "customer_id", "txn_date", "balance", end)
    anchors = F.sequence(F.trunc("seg_start", "month"), F.trunc("seg_end", "month"), F.expr("INTERVAL 1 MONTH"))
    w = window_weighted_sum(seg, "customer_id", "balance", F.col("month"), F.least(F.last_day("month"), end), anchors)
    return w.groupBy("month").agg((F.sum("balance_days") * rate / 365).alias("interest"))


def compound_interest_per_month(txns: DataFrame, rate: float = 0.06) -> DataFrame:
    """Per month: daily compound interest (each end-of-day balance, interest included, grows by rate/365).

    A net of day d has grown to net · g^(t+1-d) after day t, so with the nets discounted to the first day the balance of
    all customers is a running sum over months; the interest is what the balance gained beside the nets."""
    g = 1 + rate / 365
    nets = _ledger(txns).where(F.col("txn_date").isNotNull())
    first, end = nets.agg(F.min("txn_date")).scalar(), _end(txns)
    nets = nets.withColumns({"_all": F.xxhash64("customer_id").bitwiseAND(F.lit(0).cast("long")),  # one account
                             "_then": F.col("net") * F.pow(F.lit(g), -F.datediff("txn_date", first))})
    months = month_end_balances(nets, "_all", "txn_date", "net", end, extra_aggs={"then": F.sum("_then")})
    w = Window.partitionBy("_all").orderBy("month")
    grown = F.pow(F.lit(g), F.datediff(F.least(F.last_day("month"), end), first) + 1)
    months = months.withColumn("_sum", F.sum(F.coalesce("then", F.lit(0.0))).over(w)).withColumn("_close", F.col("_sum") * grown)
    interest = F.col("_close") - F.coalesce(F.lag("_close").over(w), F.lit(0.0)) - F.col("month_net")
    return months.withColumn("interest", interest).select("month", "interest")
