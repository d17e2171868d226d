"""Subscription payments over the order history.

Mapping: a customer's plan rows are its orders (``o_custkey``, day
``o_orderdate``, tie-breaker ``o_orderkey``); the plan is given by the
order priority: 1 → pro annual, 2 → pro monthly, 3 → basic monthly,
4 → trial, 5 → churn.  The plan prices are the case study's fixed values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyframe.operators.billing import payment_schedule
from tallyframe.plans.registry import query
from tallyframe.sources.literal import frame

PERIOD = (dt.date(1997, 1, 1), dt.date(1997, 12, 31))

# The plan dimension (id, name, price).
PLAN_ROWS = [(0, "trial", "0.00"), (1, "basic monthly", "9.90"), (2, "pro monthly", "19.90"),
             (3, "pro annual", "199.00"), (4, "churn", None)]
# Order priority (first character) → plan id.
PRIORITY_PLAN = {"1": 3, "2": 2, "3": 1, "4": 0, "5": 4}


def plans_dim(spark):
    return frame(spark, "plan_id int, plan_name string, price decimal(5,2)", PLAN_ROWS)


def order_subscriptions(t):
    code = F.substring("o_orderpriority", 1, 1)
    plan = None
    for c, p in PRIORITY_PLAN.items():
        plan = F.when(code == c, p) if plan is None else plan.when(code == c, p)
    return t.orders.select(F.col("o_custkey").alias("customer_id"), plan.alias("plan_id"),
                           F.col("o_orderdate").cast("date").alias("start_date"), "o_orderkey")


_MI = "(year({d}) * 12 + month({d}))"
_K0 = f"greatest({_MI.format(d='s.start_date')} - {_MI.format(d='s.pd')}, 0)"

_PAYMENTS_SQL = f"""
WITH plans(plan_id, plan_name, price) AS (
  VALUES (0, 'trial', 0.00), (1, 'basic monthly', 9.90), (2, 'pro monthly', 19.90),
         (3, 'pro annual', 199.00), (4, 'churn', NULL)),
subs AS (
  SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS start_date, o_orderkey,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 3 WHEN '2' THEN 2 WHEN '3' THEN 1
                                           WHEN '4' THEN 0 WHEN '5' THEN 4 END AS plan_id
  FROM orders),
seq AS (
  SELECT *, lag(plan_id) OVER w AS pp, lag(start_date) OVER w AS pd, lead(start_date) OVER w AS nd
  FROM subs WINDOW w AS (PARTITION BY customer_id ORDER BY start_date, o_orderkey)),
a AS (
  SELECT s.customer_id, s.plan_id, s.pp, s.nd, p.plan_name, p.price, q.price AS prev_price,
         CASE WHEN s.plan_id = 3 AND s.pp = 2 THEN
              CASE WHEN CAST(s.pd + to_months({_K0}) AS DATE) >= s.start_date
                   THEN CAST(s.pd + to_months({_K0}) AS DATE)
                   ELSE CAST(s.pd + to_months({_K0} + 1) AS DATE) END
              ELSE s.start_date END AS anchor,
         CASE WHEN s.plan_id IN (1, 2) THEN 1 ELSE 12 END AS step
  FROM seq s JOIN plans p ON s.plan_id = p.plan_id LEFT JOIN plans q ON s.pp = q.plan_id
  WHERE s.plan_id IN (1, 2, 3) AND p.price > 0),
k AS (
  SELECT a.*, unnest(generate_series(0, CAST(floor(({_MI.format(d="DATE '" + str(PERIOD[1]) + "'")}
                                                    - {_MI.format(d='anchor')}) / step) AS BIGINT))) AS k
  FROM a WHERE anchor <= DATE '{PERIOD[1]}'),
pay AS (
  SELECT customer_id, plan_id, plan_name, CAST(anchor + to_months(k * step) AS DATE) AS payment_date,
         CASE WHEN k = 0 AND pp = 1 THEN price - prev_price ELSE price END AS amount, nd
  FROM k)
SELECT customer_id, plan_id, plan_name, payment_date, CAST(amount AS DOUBLE) AS amount,
       CAST(row_number() OVER (PARTITION BY customer_id ORDER BY payment_date, plan_id) AS INTEGER) AS payment_order
FROM pay
WHERE payment_date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' AND (nd IS NULL OR payment_date < nd)
"""


@query("payment_schedule", oracle=_PAYMENTS_SQL)
def payments(t):
    """Payments of one year from every customer's plan history."""
    pay = payment_schedule(order_subscriptions(t), plans_dim(t.spark), *PERIOD, tie_cols=["o_orderkey"])
    return pay.withColumn("amount", F.col("amount").cast("double"))
