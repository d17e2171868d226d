"""Account ledgers: signed amounts, daily net, running and month-end balances,
balance-weighted means over calendar windows, and interest.

Every per-account window runs over rows already reduced to one per
(account, day) or (account, month), so its length is bounded by the calendar
span of the data, not by the number of transactions of the account: a hot
account is collapsed by a partial aggregate before any window sees it.
Totals over all accounts and a whole calendar come from change events: each
account gives a row where its share of a total changes, and the sums of the
changes are accumulated over the calendar, so that no stage holds accounts
times months.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def signed_amount(type_col: str, amount_col: str, signs: Mapping[str, int]) -> Column:
    """Amount with the sign of its transaction type (types not listed → NULL)."""
    expr = None
    for kind, sign in signs.items():
        val = F.col(amount_col) * F.lit(sign)
        expr = F.when(F.col(type_col) == kind, val) if expr is None else expr.when(F.col(type_col) == kind, val)
    return expr


def daily_net(df: DataFrame, keys, date_col: str, amount_col: str, out_col: str = "daily_net") -> DataFrame:
    """One row per (account, day) with the day's net amount."""
    keys = _cols(keys)
    return df.groupBy(*keys, date_col).agg(F.sum(amount_col).alias(out_col))


def running_balance(daily: DataFrame, keys, date_col: str, net_col: str,
                    out_col: str = "running_balance") -> DataFrame:
    """Balance after each day: running sum of the daily net per account."""
    keys = _cols(keys)
    w = Window.partitionBy(*keys).orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn(out_col, F.sum(net_col).over(w))


def balance_segments(balances: DataFrame, keys, date_col: str, balance_col: str, end_date: Column) -> DataFrame:
    """Intervals of constant balance: [seg_start, seg_end] (inclusive days).

    A segment starts on a transaction day and ends the day before the next
    one, or on ``end_date`` for the last segment of an account.
    """
    keys = _cols(keys)
    nxt = F.lead(date_col).over(Window.partitionBy(*keys).orderBy(date_col))
    return (balances.withColumns({"seg_start": F.col(date_col),
                                  "seg_end": F.coalesce(F.date_sub(nxt, 1), end_date)})
            .where(F.col("seg_end") >= F.col("seg_start"))
            .select(*keys, "seg_start", "seg_end", balance_col))


def month_end_balances(txns: DataFrame, keys, date_col: str, net_col: str, end_date: Column,
                       out_col: str = "closing_balance", extra_aggs: Mapping[str, Column] | None = None) -> DataFrame:
    """Closing balance of every account for every month from its first active
    month through the month of ``end_date`` (months without activity carry
    the previous balance).  ``txns`` may hold transactions or daily nets.

    Two shuffles and no join: nets per (account, month); then one row per
    account holding its month → net map (bounded by the months in the data),
    from which the month spine is generated in place.  The running sum over
    the spine then runs on data already partitioned by account.
    ``extra_aggs`` (name → aggregate expression) adds further per-month
    aggregates as columns of the spine (NULL in months without rows).
    Rows without a date belong to no month and are left out.
    """
    keys = _cols(keys)
    extra = dict(extra_aggs or {})
    zero = F.lit(0).cast(txns.schema[net_col].dataType)
    monthly = txns.where(F.col(date_col).isNotNull()).groupBy(*keys, F.trunc(date_col, "month").alias("_m")).agg(
        F.sum(net_col).alias("_net"), *[e.alias(f"_x_{n}") for n, e in extra.items()])
    entry = F.struct(F.col("_net").alias("net"), *[F.col(f"_x_{n}").alias(n) for n in extra])
    per_key = monthly.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_m", entry))).alias("_nets"), F.min("_m").alias("_first"))
    last = F.trunc(end_date, "month")
    months = F.sequence(F.col("_first"), last, F.expr("INTERVAL 1 MONTH"))
    spine = per_key.where(F.col("_first") <= last).select(*keys, "_nets", F.explode(months).alias("month"))
    w = Window.partitionBy(*keys).orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = F.try_element_at("_nets", F.col("month"))
    cols = {"month_net": F.coalesce(got["net"], zero)}
    cols.update({n: got[n] for n in extra})
    return (spine.withColumns(cols).drop("_nets")
            .withColumn(out_col, F.sum("month_net").over(w)))


def window_weighted_sum(segments: DataFrame, keys, balance_col: str, window_start: Column, window_end: Column,
                        anchors: Column, out_col: str = "balance_days") -> DataFrame:
    """Σ balance × days over a calendar window per (account, anchor month).

    ``anchors`` is an array of month starts a segment may touch (computed from
    the segment's own columns), and ``window_start``/``window_end`` give the
    window of an anchor (in terms of column ``month``).  Each segment is
    expanded only to the anchors it overlaps.
    """
    keys = _cols(keys)
    exp = segments.select(*keys, "seg_start", "seg_end", balance_col, F.explode(anchors).alias("month"))
    lo = F.greatest(F.col("seg_start"), window_start)
    hi = F.least(F.col("seg_end"), window_end)
    days = F.datediff(hi, lo) + 1
    return (exp.where(days > 0)
            .groupBy(*keys, "month").agg(F.sum(F.col(balance_col) * days).alias(out_col)))


def level_changes(monthly: DataFrame, keys, month_col: str, net_col: str) -> DataFrame:
    """Change events of the positive balance of each account: add ``opening`` and ``closing`` (the balances around the
    month) and ``change``, by how much max(balance, 0) moves in it.

    ``monthly`` has one row per account and month *with activity*, so that the result is as long as the activity and not
    as accounts times months: summed over all accounts and accumulated over the calendar, the changes give the total of
    the positive balances in every month (``accumulated``).
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(month_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    closed = monthly.withColumn("closing", F.sum(net_col).over(w)).withColumn("opening", F.col("closing") - F.col(net_col))
    zero = F.lit(0)
    return closed.withColumn("change", F.greatest("closing", zero) - F.greatest("opening", zero))


def accumulated(changes: DataFrame, month_col: str, change_col: str, end_date: Column, sums: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per month from the first change to the month of ``end_date``: ``before`` and ``level``, the sums of the
    changes of all earlier months and of these and the month's own; and the aggregates ``sums`` of the month's rows (NULL
    in months without rows).  Nothing here is longer than the calendar but the rows that come in."""
    changes = changes.withColumns({
        "_all": F.xxhash64(month_col).bitwiseAND(F.lit(0).cast("long")),  # a key that all rows share, yet no literal
        change_col: F.col(change_col).cast("decimal(20,0)")})
    spine = month_end_balances(changes, "_all", month_col, change_col, end_date, "level", sums)
    return spine.select("month", (F.col("level") - F.col("month_net")).alias("before"), "level", *(sums or {}))


def month_peaks(nets: DataFrame, keys, date_col: str, net_col: str) -> DataFrame:
    """One row per account and month with activity: ``change`` of the positive balance over the month, and ``extra``, by
    how much the highest balance of the month (opening or after any day) passes the positive opening balance."""
    keys = _cols(keys)
    daily = daily_net(nets, keys, date_col, net_col, "_net").withColumn("month", F.trunc(date_col, "month"))
    within = Window.partitionBy(*keys, "month").orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    monthly = (daily.withColumn("_prefix", F.sum("_net").over(within))
               .groupBy(*keys, "month").agg(F.sum("_net").alias("net"), F.max("_prefix").alias("_top")))
    changes = level_changes(monthly, keys, "month", "net")
    opening = F.greatest("opening", F.lit(0))
    return changes.select(*keys, "month", "change", (F.greatest(F.col("opening") + F.col("_top"), opening) - opening).alias("extra"))


def allocation_of_peaks(peaks: DataFrame, end_date: Column) -> DataFrame:
    """Per month the sum over all accounts of the highest balance reached in it, from ``month_peaks`` (of a batch, or as a
    stream emits them): what all accounts carry into the month, and what some reach above it."""
    extra = F.sum(F.col("extra").cast("decimal(20,0)"))
    levels = accumulated(peaks, "month", "change", end_date, {"extra_sum": extra})
    return levels.select("month", (F.col("before") + F.coalesce("extra_sum", F.lit(0))).alias("allocation"))


def trailing_changes(segments: DataFrame, keys, balance_col: str, days: int, end_date: Column) -> DataFrame:
    """Sums of the daily balance over the ``days`` days that end with each month, as change events.

    ``segments`` are intervals of constant balance.  Where a window lies within one segment its sum is ``days`` times
    that balance, month after month: two events, one where such windows begin and one where they end.  Only windows that
    hold a change are summed for themselves, and a change lies in the windows of at most two month ends.  One row per
    account and month with an event or such a window: ``own``, the window's sum (0 without one), and ``change`` of the
    positive sums that go on unchanged.  A month ends on its last day or on ``end_date``.
    """
    segments = segments.withColumn("_end", end_date)  # a column, for functions over arrays can't hold a subquery
    end_date = F.col("_end")
    month = lambda d: F.trunc(d, "month")
    start, stop, balance = F.col("seg_start"), F.date_add("seg_end", 1), F.col(balance_col)
    ended = F.col("seg_end") < end_date  # another segment follows
    near = lambda d: F.sequence(month(d), month(F.least(F.date_add(d, days - 2), end_date)), F.expr("INTERVAL 1 MONTH"))
    steady = F.date_add(start, days - 1)  # the first day whose window lies within the segment
    total = balance * days
    positive = F.greatest(total, F.lit(0).cast(segments.schema[balance_col].dataType))

    def entry(m: Column, own: Column, change: Column) -> Column:
        return F.struct(m.alias("month"), own.cast("long").alias("own"), change.cast("long").alias("change"))

    def window(m: Column) -> Column:
        e = F.least(F.last_day(m), end_date)
        overlap = F.datediff(F.least(F.col("seg_end"), e), F.greatest(start, F.date_sub(e, days - 1))) + 1
        within = (e >= steady) & (e <= F.col("seg_end"))
        return F.struct(m.alias("m"), F.when(within, F.lit(0)).otherwise(overlap).alias("n"))

    months = F.array_distinct(F.concat(near(start), F.when(ended, near(stop)).otherwise(F.array().cast("array<date>"))))
    own = F.transform(F.filter(F.transform(months, window), lambda x: x["n"] > 0), lambda x: entry(x["m"], balance * x["n"], F.lit(0)))
    none = F.array().cast("array<struct<month:date,own:bigint,change:bigint>>")
    begin, end = entry(month(steady), F.lit(0), positive), entry(month(stop), F.lit(0), -positive)
    going_on = (F.when(ended & (month(steady) < month(stop)), F.array(begin, end))
                .when(~ended & (steady <= end_date), F.array(begin)).otherwise(none))
    exploded = segments.select(*_cols(keys), F.inline(F.concat(own, going_on)))
    return exploded.groupBy(*_cols(keys), "month").agg(F.sum("own").alias("own"), F.sum("change").alias("change"))
