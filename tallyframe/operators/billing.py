"""Payment schedules from subscription histories.

Rules (for one period, e.g. a calendar year):
- a monthly plan pays on the same day of month as its anchor date, every
  month (dates are anchored on the start, ``add_months(anchor, k)``, so a
  start on the 31st does not drift);
- an annual plan pays once per 12 months from its anchor;
- payments of a plan row stop strictly before the customer's next plan row;
  a plan without price (churn) or of price 0 (trial) pays nothing;
- a move to an annual plan from a plan in ``defer_from`` starts at the end of
  the running monthly period: the anchor is the first monthly anniversary of
  the previous start on or after the switch date;
- the first payment of a plan row that follows a plan in ``credit_from`` is
  reduced by that plan's price (an upgrade starts at once and the month
  already paid is credited);
- ``payment_order`` numbers a customer's payments in the period by date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.states import neighbours_in_sequence, sequence_number


def _month_index(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d)


def first_anniversary_on_or_after(anchor: Column, target: Column) -> Column:
    """Smallest ``add_months(anchor, k)`` (k ≥ 0) that is on or after ``target``."""
    k0 = F.greatest(_month_index(target) - _month_index(anchor), F.lit(0))
    cand = F.add_months(anchor, k0)
    return F.when(cand >= target, cand).otherwise(F.add_months(anchor, k0 + 1))


def payment_schedule(subs: DataFrame, plans: DataFrame, period_start, period_end, *,
                     key: str = "customer_id", plan_col: str = "plan_id", start_col: str = "start_date",
                     monthly: Sequence[int] = (1, 2), annual: Sequence[int] = (3,),
                     defer_from: Sequence[int] = (2,), credit_from: Sequence[int] = (1,),
                     tie_cols: Sequence[str] = ()) -> DataFrame:
    """Payments (key, plan_id, plan_name, payment_date, amount, payment_order).

    ``plans`` has (plan_id, plan_name, price) and is a small dimension; Spark
    broadcasts it if its measured size allows.  Neighbouring plan rows come from the split-window lag/lead,
    so a customer with very many plan rows is not one task.
    """
    ps, pe = F.lit(period_start).cast("date"), F.lit(period_end).cast("date")
    order = [start_col, *tie_cols]
    rows = subs.select(key, plan_col, F.col(start_col).cast("date").alias(start_col), *tie_cols)
    split = F.col(start_col)
    rows = neighbours_in_sequence(rows, key, order, [plan_col, start_col], [start_col],
                                  prev_prefix="_p_", next_prefix="_n_", split=split)
    price = plans.select(F.col("plan_id").alias("_pid"), "plan_name", "price")
    prev_price = plans.select(F.col("plan_id").alias("_ppid"), F.col("price").alias("_prev_price"))
    rows = (rows.join(price, F.col(plan_col) == F.col("_pid"))
            .join(prev_price, F.col("_p_" + plan_col) == F.col("_ppid"), "left"))

    is_monthly = F.col(plan_col).isin(list(monthly))
    is_annual = F.col(plan_col).isin(list(annual))
    start, prev_start, nxt = F.col(start_col), F.col("_p_" + start_col), F.col("_n_" + start_col)
    deferred = is_annual & F.col("_p_" + plan_col).isin(list(defer_from))
    anchor = F.when(deferred, first_anniversary_on_or_after(prev_start, start)).otherwise(start)
    step = F.when(is_monthly, F.lit(1)).otherwise(F.lit(12))
    # Only the steps that can fall inside the period and before the next plan
    # row are generated: from one step before the period start (day-of-month
    # slack) to the last step before min(period end, next start).  So a row
    # is expanded to at most the period's months, however old it is.
    a_idx = _month_index(F.col("_anchor"))
    first_k = F.greatest(F.floor((_month_index(ps) - a_idx) / F.col("_step")) - 1, F.lit(0))
    last_k = F.floor((_month_index(F.least(pe, F.coalesce(nxt, pe))) - a_idx) / F.col("_step"))
    payable = (is_monthly | is_annual) & (F.col("price") > 0)
    sched = (rows.where(payable)
             .withColumns({"_anchor": anchor, "_step": step})
             .where(F.col("_anchor") <= pe)
             .withColumns({"_k0": first_k.cast("int"), "_k1": last_k.cast("int")})
             .where(F.col("_k1") >= F.col("_k0"))
             .withColumn("_k", F.explode(F.sequence(F.col("_k0"), F.col("_k1"))))
             .withColumn("payment_date", F.add_months(F.col("_anchor"), F.col("_k") * F.col("_step")))
             .where((F.col("payment_date") >= ps) & (F.col("payment_date") <= pe)
                    & (nxt.isNull() | (F.col("payment_date") < nxt))))
    credit = (F.col("_k") == 0) & F.col("_p_" + plan_col).isin(list(credit_from))
    amount = F.when(credit, F.col("price") - F.col("_prev_price")).otherwise(F.col("price"))
    out = sched.select(key, plan_col, "plan_name", "payment_date", amount.alias("amount"))
    return sequence_number(out, key, ["payment_date", plan_col], "payment_order",
                           split=F.col("payment_date"))
