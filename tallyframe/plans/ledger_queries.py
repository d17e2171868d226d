"""Account-ledger analyses (transactions, balances, data allocation, interest).

Mapping: the ledger is ``orders`` — account ``o_custkey``, day
``o_orderdate``, amount ``o_totalprice`` (exact, held as whole cents), type
by status: F = deposit (+), O = purchase (−), P = withdrawal (−).
Balances are signed.  Inside the queries money is a long number of cents
(exact, and summed by the fast fixed-width aggregates rather than wide
decimals); it leaves the queries as ``cents / 100.0`` doubles, the same
values an exact decimal sum converts to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.ledger import (
    accumulated,
    allocation_of_peaks,
    balance_segments,
    daily_net,
    level_changes,
    month_end_balances,
    month_peaks,
    running_balance,
    signed_amount,
    trailing_changes,
)
from tallyframe.operators.aggs import mean_half_up
from tallyframe.plans.registry import query

ROUND = 6
RATE = 0.06  # yearly interest rate, accrued daily (rate / 365)
# Transaction types and their signs.
SIGNS = {"deposit": 1, "purchase": -1, "withdrawal": -1}
STATUS_TYPES = {"F": "deposit", "O": "purchase", "P": "withdrawal"}

_LEDGER_SQL = """
ledger AS (
  SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS txn_date,
         CASE o_orderstatus WHEN 'F' THEN 'deposit' WHEN 'O' THEN 'purchase' WHEN 'P' THEN 'withdrawal' END AS txn_type,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders),
signed AS (
  SELECT customer_id, txn_date, txn_type, amount,
         CASE txn_type WHEN 'deposit' THEN amount WHEN 'purchase' THEN -amount WHEN 'withdrawal' THEN -amount END AS net
  FROM ledger),
daily AS (SELECT customer_id, txn_date, SUM(net) AS daily_net FROM signed GROUP BY customer_id, txn_date),
bal AS (
  SELECT customer_id, txn_date, daily_net,
         SUM(daily_net) OVER (PARTITION BY customer_id ORDER BY txn_date
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance
  FROM daily),
bounds AS (SELECT MAX(txn_date) AS end_date FROM ledger),
firsts AS (SELECT customer_id, MIN(txn_date) AS first_date FROM ledger GROUP BY customer_id),
spine AS (
  SELECT f.customer_id, CAST(m AS DATE) AS month
  FROM firsts f, bounds b,
       unnest(generate_series(CAST(date_trunc('month', f.first_date) AS DATE),
                              CAST(date_trunc('month', b.end_date) AS DATE), INTERVAL 1 MONTH)) AS g(m)),
monthly AS (
  SELECT customer_id, CAST(date_trunc('month', txn_date) AS DATE) AS month, SUM(daily_net) AS month_net
  FROM daily GROUP BY 1, 2),
closing AS (
  SELECT s.customer_id, s.month, COALESCE(m.month_net, 0) AS month_net,
         SUM(COALESCE(m.month_net, 0)) OVER (PARTITION BY s.customer_id ORDER BY s.month
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS closing_balance
  FROM spine s LEFT JOIN monthly m ON s.customer_id = m.customer_id AND s.month = m.month)
"""


# round(total / n, 4) half away from zero on exact integers (cents).
_MEAN4 = "(sign({total}) * ((abs({total}) * 20000 + ({n})) // (2 * ({n}))) / 10000.0)"


def ledger(t) -> DataFrame:
    typ = F.col("o_orderstatus")
    kind = None
    for status, name in STATUS_TYPES.items():
        kind = F.when(typ == status, name) if kind is None else kind.when(typ == status, name)
    return t.orders.select(F.col("o_custkey").alias("customer_id"),
                           F.col("o_orderdate").cast("date").alias("txn_date"),
                           kind.alias("txn_type"),
                           F.round(F.col("o_totalprice") * 100).cast("long").alias("amount"))


def _signed(t) -> DataFrame:
    return ledger(t).withColumn("net", signed_amount("txn_type", "amount", SIGNS))


def _daily(t) -> DataFrame:
    return daily_net(_signed(t), "customer_id", "txn_date", "net")


def _end_date(t):
    """Last day of the data, as an uncorrelated scalar subquery."""
    return ledger(t).agg(F.max("txn_date")).scalar()


def _closing(t) -> DataFrame:
    return month_end_balances(_signed(t), "customer_id", "txn_date", "net", _end_date(t))


def _one_account():
    """A key that all customers share.  It is no literal, so a window over the months stays partitioned by it."""
    return F.xxhash64("customer_id").bitwiseAND(F.lit(0).cast("long"))


def _dbl(c, digits=None):
    """Cents → currency units as a double."""
    c = F.col(c) if isinstance(c, str) else c
    c = c.cast("double") / 100.0
    return F.round(c, digits) if digits is not None else c


@query("ledger_type_summary", oracle=f"""
WITH {_LEDGER_SQL}
SELECT txn_type, COUNT(*) AS n_txn, CAST(SUM(amount) AS DOUBLE) AS total_amount FROM ledger GROUP BY txn_type
""")
def ledger_type_summary(t):
    """Count and total amount per transaction type."""
    return (ledger(t).groupBy("txn_type")
            .agg(F.count("*").alias("n_txn"), _dbl(F.sum("amount")).alias("total_amount")))


@query("avg_deposits_per_customer", oracle=f"""
WITH {_LEDGER_SQL},
per AS (SELECT customer_id, COUNT(*) AS n, SUM(amount) AS total FROM ledger WHERE txn_type = 'deposit' GROUP BY 1)
SELECT round(SUM(n) * 1.0 / COUNT(*), {ROUND}) AS avg_deposit_count,
       {_MEAN4.format(total="CAST(SUM(total) * 100 AS BIGINT)", n="COUNT(*) * 100")} AS avg_deposit_amount
FROM per
""")
def avg_deposits_per_customer(t):
    """Mean number and mean total amount of deposits per depositing customer."""
    per = (ledger(t).where(F.col("txn_type") == "deposit").groupBy("customer_id")
           .agg(F.count("*").alias("n"), F.sum("amount").alias("total")))
    return per.agg(F.round(F.sum("n") * 1.0 / F.count("*"), ROUND).alias("avg_deposit_count"),
                   mean_half_up(F.sum(F.col("total").cast("decimal(20,0)")), F.count("*") * 100, 4).alias("avg_deposit_amount"))


@query("active_customers_per_month", oracle=f"""
WITH {_LEDGER_SQL},
per AS (
  SELECT customer_id, CAST(date_trunc('month', txn_date) AS DATE) AS month,
         SUM(CASE WHEN txn_type = 'deposit' THEN 1 ELSE 0 END) AS deposits,
         SUM(CASE WHEN txn_type = 'purchase' THEN 1 ELSE 0 END) AS purchases,
         SUM(CASE WHEN txn_type = 'withdrawal' THEN 1 ELSE 0 END) AS withdrawals
  FROM ledger GROUP BY 1, 2)
SELECT month, COUNT(*) AS n_customers FROM per
WHERE deposits > 1 AND (purchases >= 1 OR withdrawals >= 1)
GROUP BY month
""")
def active_customers_per_month(t):
    """Customers per month with more than one deposit and at least one
    purchase or withdrawal in that month."""
    typ = F.col("txn_type")
    per = (ledger(t).groupBy("customer_id", F.trunc("txn_date", "month").alias("month"))
           .agg(F.count_if(typ == "deposit").alias("d"), F.count_if(typ == "purchase").alias("p"),
                F.count_if(typ == "withdrawal").alias("w")))
    return (per.where((F.col("d") > 1) & ((F.col("p") >= 1) | (F.col("w") >= 1)))
            .groupBy("month").agg(F.count("*").alias("n_customers")))


@query("month_end_balance", oracle=f"""
WITH {_LEDGER_SQL}
SELECT customer_id, month, CAST(closing_balance AS DOUBLE) AS closing_balance FROM closing
""")
def month_end_balance(t):
    """Closing balance per customer and month, from the customer's first
    month to the last month of the data (inactive months carry over)."""
    return _closing(t).select("customer_id", "month", _dbl("closing_balance").alias("closing_balance"))


@query("balance_growth_share", oracle=f"""
WITH {_LEDGER_SQL},
ends AS (
  SELECT customer_id,
         arg_min(closing_balance, month) AS opening,
         arg_max(closing_balance, month) AS final
  FROM closing GROUP BY customer_id)
SELECT CAST(SUM(CASE WHEN opening > 0 AND final > opening * 1.05 THEN 1 ELSE 0 END) AS BIGINT) AS n_growing,
       round(SUM(CASE WHEN opening > 0 AND final > opening * 1.05 THEN 1 ELSE 0 END) * 100.0 / COUNT(*), {ROUND})
         AS pct
FROM ends
""")
def balance_growth_share(t):
    """Customers whose last closing balance exceeds their first by more than
    5% (only positive first balances can grow), and their percent of all."""
    # the first closing balance is the first month's net, the last one the total: no month spine
    monthly = _signed(t).where(F.col("txn_date").isNotNull()).groupBy(
        "customer_id", F.trunc("txn_date", "month").alias("month")).agg(F.sum("net").alias("net"))
    ends = monthly.groupBy("customer_id").agg(F.min_by("net", "month").alias("opening"), F.sum("net").alias("final"))
    grow = (F.col("opening") > 0) & (F.col("final") * 100 > F.col("opening") * 105)
    return ends.agg(F.count_if(grow).alias("n_growing"),
                    F.round(F.count_if(grow) * 100.0 / F.count("*"), ROUND).alias("pct"))


@query("running_balance", oracle=f"""
WITH {_LEDGER_SQL}
SELECT customer_id, txn_date, CAST(daily_net AS DOUBLE) AS daily_net, CAST(balance AS DOUBLE) AS running_balance
FROM bal
""")
def running_balance_q(t):
    """Balance after every transaction day of every customer."""
    b = running_balance(_daily(t), "customer_id", "txn_date", "daily_net")
    return b.select("customer_id", "txn_date", _dbl("daily_net").alias("daily_net"),
                    _dbl("running_balance").alias("running_balance"))


@query("balance_stats", oracle=f"""
WITH {_LEDGER_SQL}
SELECT customer_id, CAST(MIN(balance) AS DOUBLE) AS min_balance,
       {_MEAN4.format(total="CAST(SUM(balance) * 100 AS BIGINT)", n="COUNT(*) * 100")} AS avg_balance,
       CAST(MAX(balance) AS DOUBLE) AS max_balance
FROM bal GROUP BY customer_id
""")
def balance_stats(t):
    """Minimum, mean and maximum running balance per customer (over the
    balances after each transaction day)."""
    b = running_balance(_daily(t), "customer_id", "txn_date", "daily_net")
    return b.groupBy("customer_id").agg(
        _dbl(F.min("running_balance")).alias("min_balance"),
        mean_half_up(F.sum(F.col("running_balance").cast("decimal(20,0)")), F.count("*") * 100, 4).alias("avg_balance"),
        _dbl(F.max("running_balance")).alias("max_balance"))


@query("allocation_prev_month_end", oracle=f"""
WITH {_LEDGER_SQL},
p AS (
  SELECT month, lag(closing_balance) OVER (PARTITION BY customer_id ORDER BY month) AS prev_closing
  FROM closing)
SELECT month, CAST(SUM(greatest(prev_closing, 0)) AS DOUBLE) AS allocation
FROM p WHERE prev_closing IS NOT NULL GROUP BY month
""")
def allocation_prev_month_end(t):
    """Option 1: per month, the sum over customers of the previous month's
    closing balance (negative balances need nothing)."""
    monthly = _nets(t).groupBy("customer_id", F.trunc("txn_date", "month").alias("month")).agg(F.sum("net").alias("net"))
    levels = accumulated(level_changes(monthly, "customer_id", "month", "net"), "month", "change", _end_date(t))
    first = _nets(t).agg(F.trunc(F.min("txn_date"), "month")).scalar()  # nobody has a month before it
    return levels.where(F.col("month") > first).select("month", _dbl("before").alias("allocation"))


@query("allocation_realtime", oracle=f"""
WITH {_LEDGER_SQL},
peaks AS (
  SELECT customer_id, CAST(date_trunc('month', txn_date) AS DATE) AS month, MAX(balance) AS peak
  FROM bal GROUP BY 1, 2),
c AS (
  SELECT customer_id, month,
         COALESCE(lag(closing_balance) OVER (PARTITION BY customer_id ORDER BY month), 0) AS opening
  FROM closing)
SELECT c.month, CAST(SUM(greatest(c.opening, COALESCE(p.peak, c.opening), 0)) AS DOUBLE) AS allocation
FROM c LEFT JOIN peaks p ON c.customer_id = p.customer_id AND c.month = p.month
GROUP BY c.month
""")
def allocation_realtime(t):
    """Option 3: per month, the sum over customers of the highest balance the
    account reaches in the month (opening balance or any day's balance)."""
    return allocation_of_peaks(month_peaks(_nets(t), "customer_id", "txn_date", "net"), _end_date(t)) \
        .select("month", _dbl("allocation").alias("allocation"))


def _nets(t) -> DataFrame:
    """Signed amounts of dated rows, 0 for types without a sign."""
    return _signed(t).where(F.col("txn_date").isNotNull()).withColumn("net", F.coalesce("net", F.lit(0)))


@query("allocation_trailing_30d", oracle=f"""
WITH {_LEDGER_SQL},
days AS (
  SELECT f.customer_id, CAST(d AS DATE) AS day
  FROM firsts f, bounds b, unnest(generate_series(f.first_date, b.end_date, INTERVAL 1 DAY)) AS g(d)),
dbal AS (
  SELECT d.customer_id, d.day,
         (SELECT b2.balance FROM bal b2 WHERE b2.customer_id = d.customer_id AND b2.txn_date <= d.day
          ORDER BY b2.txn_date DESC LIMIT 1) AS balance
  FROM days d),
ends AS (
  SELECT DISTINCT customer_id, month, least(last_day(month), (SELECT end_date FROM bounds)) AS e FROM closing),
w AS (
  SELECT ends.customer_id, ends.month, SUM(dbal.balance) AS balance_days
  FROM ends JOIN dbal ON dbal.customer_id = ends.customer_id
   AND dbal.day BETWEEN ends.e - 29 AND ends.e
  GROUP BY 1, 2)
SELECT month, round(CAST(SUM(greatest(balance_days, 0)) AS DOUBLE) / 30, 4) AS allocation
FROM w GROUP BY month
""")
def allocation_trailing_30d(t):
    """Option 2: per month, the sum over customers of the mean end-of-day
    balance over the 30 days ending on the month's last day (days before an
    account's first transaction count as 0; negative means need nothing).

    Only windows that hold a transaction are summed for each account; all
    others go on from month to month as they are."""
    end = _end_date(t)
    balances = running_balance(daily_net(_nets(t), "customer_id", "txn_date", "net"), "customer_id", "txn_date", "daily_net", "balance")
    segments = balance_segments(balances, "customer_id", "txn_date", "balance", end)
    parts = trailing_changes(segments, "customer_id", "balance", 30, end)
    own = F.sum(F.greatest("own", F.lit(0)).cast("decimal(20,0)"))
    levels = accumulated(parts, "month", "change", end, {"own_sum": own})
    return levels.select("month", F.round(_dbl(F.col("level") + F.col("own_sum")) / 30, 4).alias("allocation"))


@query("interest_simple", oracle=f"""
WITH {_LEDGER_SQL},
days AS (
  SELECT f.customer_id, CAST(d AS DATE) AS day
  FROM firsts f, bounds b, unnest(generate_series(f.first_date, b.end_date, INTERVAL 1 DAY)) AS g(d)),
dbal AS (
  SELECT d.customer_id, d.day,
         (SELECT b2.balance FROM bal b2 WHERE b2.customer_id = d.customer_id AND b2.txn_date <= d.day
          ORDER BY b2.txn_date DESC LIMIT 1) AS balance
  FROM days d)
SELECT CAST(date_trunc('month', day) AS DATE) AS month,
       round(CAST(SUM(balance) AS DOUBLE) * {RATE} / 365, 2) AS interest
FROM dbal GROUP BY 1
""")
def interest_simple(t):
    """Daily simple interest (rate/365 on each end-of-day balance, signed)
    summed per month over all customers."""
    # Linear in the nets, so all customers are one account: a net counts for the rest of
    # its own month and for every day of the months after.
    end = _end_date(t)
    rest = F.datediff(F.least(F.last_day("txn_date"), end), "txn_date") + 1
    nets = _signed(t).select(_one_account().alias("_all"), "txn_date", F.col("net").cast("decimal(20,0)").alias("net"))
    spine = month_end_balances(nets, "_all", "txn_date", "net", end, extra_aggs={"own": F.sum(F.col("net") * rest)})
    days = F.datediff(F.least(F.last_day("month"), end), "month") + 1
    before = F.col("closing_balance") - F.col("month_net")
    return spine.select("month", F.round(_dbl(before * days + F.coalesce("own", F.lit(0))) * RATE / 365, 2).alias("interest"))


@query("interest_compound", oracle=f"""
WITH RECURSIVE {_LEDGER_SQL},
daynet AS (SELECT customer_id, txn_date AS day, CAST(daily_net AS DOUBLE) AS net FROM daily),
rec(customer_id, day, b) AS (
  SELECT f.customer_id, f.first_date,
         (SELECT d.net FROM daynet d WHERE d.customer_id = f.customer_id AND d.day = f.first_date) * (1 + {RATE} / 365)
  FROM firsts f
  UNION ALL
  SELECT r.customer_id, CAST(r.day + 1 AS DATE),
         (r.b + COALESCE((SELECT d.net FROM daynet d WHERE d.customer_id = r.customer_id AND d.day = r.day + 1), 0))
         * (1 + {RATE} / 365)
  FROM rec r, bounds WHERE r.day < bounds.end_date)
SELECT CAST(date_trunc('month', day) AS DATE) AS month,
       round(SUM(b - b / (1 + {RATE} / 365)), 2) AS interest
FROM rec GROUP BY 1
""")
def interest_compound(t):
    """Daily compound interest (each day's end balance, interest included,
    grows by rate/365), summed per month over all customers.

    Closed form instead of a day-by-day loop: the end-of-day balance on day t
    is (1+r)^(t+1) · Σ_{i≤t} net_i (1+r)^(-i), a running sum per account.
    Day i counts from the first day of the data; over a century (1+r)^i stays
    below e^6, so doubles keep about 13 significant digits.
    (The oracle is the day-by-day recursion itself.)"""
    g = 1 + RATE / 365
    d0 = ledger(t).agg(F.min("txn_date")).scalar()
    end = _end_date(t)
    # Discounted amounts summed per month alongside the nets: one month spine,
    # no separate aggregate and join.
    k = _dbl("net") * F.pow(F.lit(g), -F.datediff("txn_date", d0))
    # Linear in the nets, so all customers are one account.
    nets = _signed(t).select(_one_account().alias("_all"), "txn_date", F.col("net").cast("decimal(20,0)").alias("net"))
    spine = month_end_balances(nets, "_all", "txn_date", "net", end, extra_aggs={"k_month": F.sum(k)})
    w = Window.partitionBy("_all").orderBy("month")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = (spine.withColumns({"s_end": F.sum(F.coalesce("k_month", F.lit(0.0))).over(running),
                            "e": F.least(F.last_day("month"), end)})
         .withColumn("b_end", F.col("s_end") * F.pow(F.lit(g), F.datediff("e", d0) + 1)))
    i = s.withColumn("interest", F.col("b_end") - F.coalesce(F.lag("b_end").over(w), F.lit(0.0))
                     - _dbl("month_net"))
    return i.select("month", F.round("interest", 2).alias("interest"))
