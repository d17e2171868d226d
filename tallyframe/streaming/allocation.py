"""The real-time data allocation of an account ledger, as keyed state with event-time timers.

An account's highest balance of a month is known when the month can no longer change: when the watermark has passed its
end.  The state of an account is its balance at the end of its last closed month and the nets of the days after it, at
most the days within the lateness and the running month.  A timer stands at the end of the earliest open month; when it
fires, or when rows come after it, all months behind the watermark are closed and each gives one row, in the form of
``operators.ledger.month_peaks``.  Months without activity give none: ``allocation_of_peaks`` sums the rows of a batch
and of a stream alike.

Rows behind the watermark never reach the state, so a closed month stays as it is; Spark drops them and counts them, and
``streaming.append.dropped_late`` tells their number.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EPOCH = dt.date(1970, 1, 1)
_OUT = "account {kind}, month date, change long, extra long, n_days int"
_STATE = "balance long, days array<int>, nets array<long>"


def _month(day: int) -> dt.date:
    return (EPOCH + dt.timedelta(days=day)).replace(day=1)


def _end_ms(month: dt.date) -> int:
    """The first instant after a month, in milliseconds since 1970 (UTC, as the watermark)."""
    after = month.replace(year=month.year + month.month // 12, month=month.month % 12 + 1)
    return (after - EPOCH).days * 86_400_000


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Take the rows of one account, close the months behind the watermark, set the timer for the next."""
    balance, days, nets = state.get if state.exists else (0, [], [])
    pending: dict[int, int] = dict(zip(days, nets, strict=True))
    for frame in () if state.hasTimedOut else frames:
        for day, total in frame.groupby("day")["net"].sum().items():
            pending[int(day)] = pending.get(int(day), 0) + int(total)
    watermark = state.getCurrentWatermarkMs()
    rows = []
    by_month: dict[dt.date, list[int]] = defaultdict(list)
    for day in sorted(pending):
        by_month[_month(day)].append(day)
    open_months = []
    for month, own in by_month.items():
        if _end_ms(month) > watermark:
            open_months.append(month)
            continue
        opening = top = balance
        for day in own:
            balance += pending.pop(day)
            top = max(top, balance)
        positive = max(opening, 0)
        rows.append((key[0], month, max(balance, 0) - positive, max(top, 0) - positive, len(own)))
    order = sorted(pending)
    state.update((balance, order, [pending[d] for d in order]))
    if open_months:
        state.setTimeoutTimestamp(_end_ms(open_months[0]))
    if rows:
        yield pd.DataFrame(rows, columns=["account", "month", "change", "extra", "n_days"])


def month_peaks_stream(stream: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Rows (account, month, change, extra, n_days) of a stream of signed amounts (account, ts, net), where ``net`` is a
    whole number such as cents; append mode.

    They are those of ``operators.ledger.month_peaks``, once per account and month with activity, with the number of its
    days that have any.  A null net counts as 0, rows without a time belong to no month, null accounts are one account.
    The rows of one account in one micro-batch go to one task, in chunks; ``maxFilesPerTrigger`` bounds them.
    """
    kind = stream.schema["account"].dataType.simpleString()
    days = stream.where(F.col("ts").isNotNull()).withWatermark("ts", lateness).select(
        "account", "ts", F.unix_date(F.to_date("ts")).alias("day"), F.coalesce(F.col("net").cast("long"), F.lit(0)).alias("net"))
    return days.groupBy("account").applyInPandasWithState(
        _advance, _OUT.format(kind=kind), _STATE, "append", GroupStateTimeout.EventTimeTimeout)
