"""Subscription analyses over the case study's own layout:
plans(plan_id, plan_name, price) and subscriptions(customer_id, plan_id,
start_date).  Plan ids: 0 trial, 1 basic monthly, 2 pro monthly,
3 pro annual, 4 churn."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.calendar import after_year, in_year
from tallyframe.operators.aggs import percent_half_up, share_of_total
from tallyframe.operators.billing import payment_schedule
from tallyframe.operators.states import as_of_state, first_to_first_days, transitions

# Plan ids of the case study.
TRIAL, BASIC, PRO_MONTHLY, PRO_ANNUAL, CHURN = 0, 1, 2, 3, 4


def journeys(subs: DataFrame, plans: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Plan rows with name and price (optionally only for given customers,
    e.g. a sample to describe)."""
    out = subs.join(plans, "plan_id")
    if customers is not None:
        out = out.join(customers.select("customer_id").distinct(), "customer_id", "left_semi")
    return out


def customer_count(subs: DataFrame) -> DataFrame:
    return subs.agg(F.count_distinct("customer_id").alias("customers"))


def trial_starts_per_month_literal(subs: DataFrame) -> DataFrame:
    """Trial starts per month *number* (years merged, as the original)."""
    return (subs.where(F.col("plan_id") == TRIAL).groupBy(F.month("start_date").alias("month"))
            .agg(F.count("*").alias("n")).orderBy("month"))


def trial_starts_per_month(subs: DataFrame) -> DataFrame:
    """Trial starts per calendar month (first day of the month)."""
    return (subs.where(F.col("plan_id") == TRIAL).groupBy(F.trunc("start_date", "month").alias("month_start"))
            .agg(F.count("*").alias("n")))


def starts_after_year(subs: DataFrame, plans: DataFrame, year: int = 2020) -> DataFrame:
    return (subs.where(after_year("start_date", year)).join(plans, "plan_id")
            .groupBy("plan_name").agg(F.count("*").alias("n")))


def churn_rows_literal(subs: DataFrame) -> DataFrame:
    """Churn rows and their percent of all rows, 1 decimal."""
    n = F.count_if(F.col("plan_id") == CHURN)
    return subs.agg(n.alias("customer_count"), percent_half_up(n, F.count("*"), 1).alias("churn_percentage"))


def churned_customers(subs: DataFrame) -> DataFrame:
    """Churned customers and their percent of customers, 1 decimal."""
    per = subs.groupBy("customer_id").agg(F.max(F.col("plan_id") == CHURN).alias("churned"))
    n = F.count_if("churned")
    return per.agg(n.alias("customer_count"), percent_half_up(n, F.count("*"), 1).alias("churn_percentage"))


def churn_without_paying(subs: DataFrame) -> DataFrame:
    """Customers who churned and never had a paid plan (1-3), with their
    percent of all customers (one aggregation per customer, no self-join)."""
    per = subs.groupBy("customer_id").agg(
        F.max(F.col("plan_id").between(BASIC, PRO_ANNUAL)).alias("paid"),
        F.count_if(F.col("plan_id") == CHURN).alias("churn_rows"))
    n = F.sum(F.when(~F.col("paid"), F.col("churn_rows")).otherwise(0))
    return per.agg(n.cast("long").alias("num_customer"), (n * 100.0 / F.count("*")).alias("percentage"))


def plans_after_trial_literal(subs: DataFrame) -> DataFrame:
    """Non-trial rows, and trial rows as a percent of all rows."""
    trial = F.col("plan_id") == TRIAL
    return subs.agg(F.count_if(~trial).alias("number_plans"),
                    (F.count_if(trial) * 100.0 / F.count("*")).alias("percentage_plan"))


def plan_breakdown_on_date_literal(subs: DataFrame, day=dt.date(2020, 12, 31)) -> DataFrame:
    """Plans *starting on* a date, count and percent of them."""
    counts = subs.where(F.col("start_date") == F.lit(day)).groupBy("plan_id").agg(F.count("*").alias("total_count"))
    return share_of_total(counts, "total_count", "percentage")


def plan_breakdown_as_of(subs: DataFrame, plans: DataFrame, day=dt.date(2020, 12, 31)) -> DataFrame:
    """Plan *held* by every customer on a date, count and percent of customers."""
    held = as_of_state(subs, "customer_id", "start_date", ["plan_id"], F.lit(day))
    counts = held.groupBy("plan_id").agg(F.count("*").alias("customers"))
    return share_of_total(counts, "customers", "percentage").join(plans.select("plan_id", "plan_name"),
                                                                  "plan_id")


def annual_upgrades_in_year(subs: DataFrame, plans: DataFrame, year: int = 2020) -> DataFrame:
    return (subs.where(in_year("start_date", year))
            .join(plans.where(F.col("plan_name").ilike("%annual%")).select("plan_id"), "plan_id")
            .agg(F.count("*").alias("upgrades")))


def _trial_to_annual(subs: DataFrame) -> DataFrame:
    return first_to_first_days(subs, "customer_id", "start_date", "plan_id", TRIAL, PRO_ANNUAL, "days")


def avg_days_to_annual(subs: DataFrame) -> DataFrame:
    d = _trial_to_annual(subs)
    return d.agg((F.sum("days") / F.count("*")).alias("avg_days"))


def avg_periods_to_annual_literal(subs: DataFrame) -> DataFrame:
    d = _trial_to_annual(subs)
    return d.agg((F.sum(F.col("days") / 30) / F.count("*")).alias("avg_periods"))


def days_to_annual_buckets(subs: DataFrame, width: int = 30) -> DataFrame:
    """Customers per period of ``width`` days: '0-30 days', '31-60 days', …"""
    d = _trial_to_annual(subs)
    b = F.greatest(F.ceil(F.col("days") / width), F.lit(1)).cast("int")
    label = F.concat(F.when(b == 1, F.lit(0)).otherwise((b - 1) * width + 1).cast("string"), F.lit("-"),
                     (b * width).cast("string"), F.lit(" days"))
    return (d.withColumn("_b", b).groupBy("_b", label.alias("period"))
            .agg(F.count("*").alias("customers"), F.avg("days").alias("avg_days"))
            .orderBy("_b").drop("_b"))


def basic_starts_in_year_literal(subs: DataFrame, year: int = 2020) -> DataFrame:
    return subs.where((F.col("plan_id") == BASIC) & in_year("start_date", year)).agg(F.count("*").alias("n"))


def downgrades_in_year(subs: DataFrame, year: int = 2020) -> DataFrame:
    """Customers moving straight from pro monthly to basic monthly in a year."""
    moves = transitions(subs, "customer_id", "start_date", "plan_id", PRO_MONTHLY, BASIC,
                        split=F.to_date("start_date"))
    return (moves.where(F.year("start_date") == year)
            .agg(F.count_distinct("customer_id").alias("downgraded_customers")))


def payments(subs: DataFrame, plans: DataFrame, year: int = 2020) -> DataFrame:
    """The payments table of one year (see ``payment_schedule`` for rules)."""
    return payment_schedule(subs, plans, dt.date(year, 1, 1), dt.date(year, 12, 31))
