"""Subscription analyses over the event log and the orders.

Mapping: a subscription history is a user's events (``user_id``, ``ts``,
``event_type`` as the plan); plan starts of one kind are orders of one
status (``o_orderstatus``, ``o_orderdate``); the plan dimension is the
customer's market segment where a name is needed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallyframe.functions.calendar import after_year, in_year
from tallyframe.operators.aggs import mean_half_up, percent_half_up, share_of_total
from tallyframe.operators.states import as_of_state, first_to_first_days, transitions
from tallyframe.plans.registry import query

ROUND = 6
SHARE_DATE = dt.date(1996, 9, 17)
AS_OF = dt.datetime(2024, 1, 15)


def _ntz(value: dt.datetime):
    """A wall-clock timestamp literal, independent of the session time zone
    (the tables' timestamps carry no zone)."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


@query("events_with_user", oracle="""
SELECT e.event_id, e.user_id, e.event_type, e.ts, c.c_name, c.c_acctbal
FROM events e JOIN customer c ON e.user_id = c.c_custkey
""")
def events_with_user(t):
    """Every history row with the customer's name and balance (the
    reference showed a sample of customers; here the whole log is joined)."""
    return (t.events.select("event_id", "user_id", "event_type", "ts")
            .join(t.customer.select("c_custkey", "c_name", "c_acctbal"), F.col("user_id") == F.col("c_custkey"))
            .drop("c_custkey"))


@query("distinct_users", oracle="SELECT COUNT(DISTINCT user_id) AS n_users FROM events")
def distinct_users(t):
    return t.events.agg(F.count_distinct("user_id").alias("n_users"))


@query("signups_per_month", oracle="""
SELECT CAST(month(o_orderdate) AS INTEGER) AS month_no, COUNT(*) AS n_starts
FROM orders WHERE o_orderstatus = 'O' GROUP BY month(o_orderdate)
""")
def signups_per_month(t):
    """Starts of one kind per month number (year dropped, as in the source)."""
    return (t.orders.where(F.col("o_orderstatus") == "O")
            .groupBy(F.month("o_orderdate").alias("month_no")).agg(F.count("*").alias("n_starts"))
            .orderBy("month_no"))


@query("late_orders_by_segment", oracle="""
SELECT c.c_mktsegment, COUNT(*) AS n_orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE year(o.o_orderdate) > 1998
GROUP BY c.c_mktsegment
""")
def late_orders_by_segment(t):
    """Rows starting after a year, per dimension name.  Orders are counted per
    customer first, so the customer join sees one row per customer."""
    per_cust = (t.orders.where(after_year("o_orderdate", 1998, "timestamp_ntz"))
                .groupBy("o_custkey").agg(F.count("*").alias("_n")))
    return (per_cust.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("c_mktsegment").agg(F.sum("_n").alias("n_orders")))


@query("error_rate", oracle="""
SELECT CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n_errors,
       ((SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) * 2000 + COUNT(*)) // (2 * COUNT(*))) / 10.0
         AS error_pct
FROM events
""")
def error_rate(t):
    """Rows of one state and their percent of all rows, 1 decimal."""
    n = F.count_if(F.col("event_type") == "error")
    return t.events.agg(n.alias("n_errors"), percent_half_up(n, F.count("*"), 1).alias("error_pct"))


@query("errored_never_purchased", oracle=f"""
WITH q AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase')
SELECT CAST(SUM(CASE WHEN q.user_id IS NULL AND e.event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS n_rows,
       round(SUM(CASE WHEN q.user_id IS NULL AND e.event_type = 'error' THEN 1 ELSE 0 END) * 100.0
             / COUNT(DISTINCT e.user_id), {ROUND}) AS pct
FROM events e LEFT JOIN q ON e.user_id = q.user_id
""")
def errored_never_purchased(t):
    """Error rows of users who never purchased, and that count per 100 users.

    One aggregation per user (has a purchase? how many errors?) replaces the
    distinct-users left join; the global sums then run over one row per user."""
    per_user = t.events.groupBy("user_id").agg(
        F.max(F.col("event_type") == "purchase").alias("_bought"),
        F.count_if(F.col("event_type") == "error").alias("_err"))
    # a NULL user is nobody: not counted as a user, and its purchases clear nobody
    n = F.sum(F.when(~F.col("_bought") | F.col("user_id").isNull(), F.col("_err")).otherwise(0))
    return per_user.agg(n.cast("long").alias("n_rows"),
                        F.round(n * 100.0 / F.count("user_id"), ROUND).alias("pct"))


@query("non_view_counts", oracle=f"""
SELECT CAST(SUM(CASE WHEN NOT event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS n_other,
       round(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) * 100.0 / COUNT(*), {ROUND}) AS view_pct
FROM events
""")
def non_view_counts(t):
    """Rows not in the initial state, and the initial state's percent of rows."""
    is_view = F.col("event_type") == "view"
    return t.events.agg(F.count_if(~is_view).alias("n_other"),
                        F.round(F.count_if(is_view) * 100.0 / F.count("*"), ROUND).alias("view_pct"))


@query("status_share", oracle=f"""
SELECT o_orderstatus, COUNT(*) AS n_orders,
       round(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), {ROUND}) AS pct
FROM orders WHERE o_orderdate = TIMESTAMP '{SHARE_DATE} 00:00:00'
GROUP BY o_orderstatus
""")
def status_share(t):
    """Count and percent of total per status, for rows starting on one date."""
    counts = (t.orders.where(F.col("o_orderdate") == _ntz(dt.datetime.combine(SHARE_DATE, dt.time())))
              .groupBy("o_orderstatus").agg(F.count("*").alias("n_orders")))
    return share_of_total(counts, "n_orders", "pct").withColumn("pct", F.round("pct", ROUND))


@query("matching_parts_in_year", oracle="""
SELECT COUNT(*) AS n_lines
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE p.p_name ILIKE '%ring%' AND year(l.l_shipdate) = 1998
""")
def matching_parts_in_year(t):
    """Rows in a year whose dimension name matches a pattern (case-insensitive)."""
    per_part = (t.lineitem.where(in_year("l_shipdate", 1998, "timestamp_ntz"))
                .groupBy("l_partkey").agg(F.count("*").alias("_n")))
    parts = t.part.where(F.col("p_name").ilike("%ring%")).select("p_partkey")
    return (per_part.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_lines")))


_FIRST_SQL = """
v AS (SELECT user_id, MIN(ts) AS first_view FROM events WHERE event_type = 'view' GROUP BY user_id),
p AS (SELECT user_id, MIN(ts) AS first_purchase FROM events WHERE event_type = 'purchase' GROUP BY user_id),
d AS (
  SELECT v.user_id, date_diff('day', CAST(v.first_view AS DATE), CAST(p.first_purchase AS DATE)) AS days
  FROM v JOIN p ON v.user_id = p.user_id)
"""


def _first_view_to_purchase(t):
    return first_to_first_days(t.events.select("user_id", "ts", "event_type"), "user_id", "ts", "event_type",
                               "view", "purchase", "days")


@query("avg_days_first_view_to_purchase", oracle=f"""
WITH {_FIRST_SQL}
SELECT concat(CAST(sign(SUM(days)) * ((abs(SUM(days)) * 200 + COUNT(*)) // (2 * COUNT(*))) / 100.0
              AS DECIMAL(18,2)), ' days') AS avg_days
FROM d
""")
def avg_days_first_view_to_purchase(t):
    """Mean days from a user's first view to first purchase, 'x.yy days'."""
    d = _first_view_to_purchase(t)
    avg = mean_half_up(F.sum("days"), F.count("*"), 2).cast("decimal(18,2)").cast("string")
    return d.agg(F.concat(avg, F.lit(" days")).alias("avg_days"))


@query("avg_periods_first_view_to_purchase", oracle=f"""
WITH {_FIRST_SQL}
SELECT round(SUM(days / 30.0) / COUNT(*), {ROUND}) AS avg_periods FROM d
""")
def avg_periods_first_view_to_purchase(t):
    """The same mean in 30-day periods."""
    d = _first_view_to_purchase(t)
    return d.agg(F.round(F.sum(F.col("days") / 30.0) / F.count("*"), ROUND).alias("avg_periods"))


@query("starts_in_year", oracle="""
SELECT COUNT(*) AS n_orders FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1996
""")
def starts_in_year(t):
    return (t.orders.where((F.col("o_orderstatus") == "F") & in_year("o_orderdate", 1996, "timestamp_ntz"))
            .agg(F.count("*").alias("n_orders")))


@query("state_as_of", oracle=f"""
WITH s AS (
  SELECT user_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE ts <= TIMESTAMP '{AS_OF}')
SELECT event_type, COUNT(*) AS n_users,
       round(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), {ROUND}) AS pct
FROM s WHERE rn = 1 GROUP BY event_type
""")
def state_as_of(t):
    """State held by each user at a point in time (latest row at or before
    it), counted per state with its percent of users."""
    latest = as_of_state(t.events, "user_id", "ts", ["event_type"], _ntz(AS_OF), tie_cols=["event_id"])
    counts = latest.groupBy("event_type").agg(F.count("*").alias("n_users"))
    return share_of_total(counts, "n_users", "pct").withColumn("pct", F.round("pct", ROUND))


@query("days_to_fulfilment_buckets", oracle="""
WITH a AS (SELECT o_custkey, MIN(o_orderdate) AS first_p FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey),
b AS (SELECT o_custkey, MIN(o_orderdate) AS first_f FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey),
d AS (
  SELECT date_diff('day', CAST(a.first_p AS DATE), CAST(b.first_f AS DATE)) AS days
  FROM a JOIN b ON a.o_custkey = b.o_custkey)
SELECT CAST(floor(days / 30.0) * 30 AS BIGINT) AS bucket_start, COUNT(*) AS n_customers
FROM d GROUP BY 1
""")
def days_to_fulfilment_buckets(t):
    """Customers per 30-day period of the days from their first pending to
    their first fulfilled order (bucket = start day of the period)."""
    d = first_to_first_days(t.orders.select("o_custkey", "o_orderdate", "o_orderstatus"), "o_custkey",
                            "o_orderdate", "o_orderstatus", "P", "F", "days")
    return (d.groupBy((F.floor(F.col("days") / 30) * 30).cast("long").alias("bucket_start"))
            .agg(F.count("*").alias("n_customers")))


@query("view_to_purchase_transitions", oracle="""
WITH s AS (
  SELECT user_id, event_type,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_type
  FROM events)
SELECT COUNT(DISTINCT user_id) AS n_users FROM s WHERE prev_type = 'view' AND event_type = 'purchase'
""")
def view_to_purchase_transitions(t):
    """Users with at least one direct move from one state to another."""
    moves = transitions(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", "ts",
                        "event_type", "view", "purchase", tie_cols=["event_id"])
    return moves.agg(F.count_distinct("user_id").alias("n_users"))
