"""Operators against brute-force Python on random inputs, including one hot
key spread over many slices, ties, NULLs and repeated values."""

import datetime as dt
import math
import random
from collections import defaultdict
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.aggs import (ordered_list, ordered_list_in_slices, rank_percentiles,
                                       rank_percentiles_from_histogram)
from tallyframe.operators.distinct import bitmap_counts, distinct_bitmaps, merged_bitmaps
from tallyframe.operators.joins import salted_full_outer_merge
from tallyframe.operators.ledger import (accumulated, allocation_of_peaks, balance_segments, daily_net, level_changes,
                                         month_end_balances, month_peaks, running_balance, trailing_changes,
                                         window_weighted_sum)
from tallyframe.operators.states import (change_gaps, neighbours_in_sequence, previous_in_sequence,
                                         sequence_number, state_calendar)

D0 = dt.date(2020, 1, 1)


def _history(seed, n=600, hot_share=0.4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < hot_share else rnd.choice([1, 2, 3, 4, 5, 6, 7, 8, None])
        day = D0 + dt.timedelta(days=rnd.randint(0, 120)) if rnd.random() < 0.97 else None
        state = rnd.choice(["a", "b", "c", None]) if rnd.random() < 0.9 else None
        rows.append((key, day, i, state))   # i: unique tie-breaker
    return rows


def _by_key(rows):
    g = defaultdict(list)
    for r in rows:
        g[r[0]].append(r)   # a NULL key is one group, like a window partition
    for k in g:   # NULL days sort first, as in an ascending window
        g[k].sort(key=lambda r: (r[1] is not None, r[1] or D0, r[2]))
    return g


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_previous_and_next_match_plain_lag(spark, seed):
    rows = _history(seed)
    df = spark.createDataFrame(rows, "k int, d date, i int, s string")
    split = F.trunc("d", "month")
    prev = previous_in_sequence(df, "k", ["d", "i"], ["s", "i"], split=split)
    nxt = previous_in_sequence(df, "k", ["d", "i"], ["i"], prefix="next_", split=split, direction="next")
    both = neighbours_in_sequence(df, "k", ["d", "i"], ["i"], ["i"], split=split)
    exp_prev, exp_next = {}, {}
    for k, rs in _by_key(rows).items():
        for j, r in enumerate(rs):
            exp_prev[r[2]] = (rs[j - 1][3], rs[j - 1][2]) if j else (None, None)
            exp_next[r[2]] = rs[j + 1][2] if j + 1 < len(rs) else None
    assert {r["i"]: (r["prev_s"], r["prev_i"]) for r in prev.collect()} == exp_prev
    assert {r["i"]: r["next_i"] for r in nxt.collect()} == exp_next
    got = {r["i"]: (r["prev_i"], r["next_i"]) for r in both.collect()}
    assert got == {i: (exp_prev[i][1], exp_next[i]) for i in exp_prev}


@pytest.mark.parametrize("seed", [4, 5])
def test_sequence_number_matches_row_number(spark, seed):
    rows = _history(seed)
    df = spark.createDataFrame(rows, "k int, d date, i int, s string")
    got = {r["i"]: r["seq_no"] for r in sequence_number(df, "k", ["d", "i"], split=F.trunc("d", "month")).collect()}
    exp = {r[2]: j + 1 for rs in _by_key(rows).values() for j, r in enumerate(rs)}
    assert got == exp


@pytest.mark.parametrize("seed", [6, 7])
def test_change_gaps(spark, seed):
    rows = _history(seed)
    df = spark.createDataFrame(rows, "k int, d date, i int, s string")
    got = sorted((r["i"], r["gap_days"]) for r in change_gaps(df, "k", "d", "s", tie_cols=["i"]).collect())
    exp = []
    for rs in _by_key(rows).values():
        for a, b in zip(rs, rs[1:]):
            same = a[3] is not None and b[3] is not None and a[3] == b[3]
            if not same and a[1] is not None:   # a previous row without a time gives no gap
                exp.append((b[2], (b[1] - a[1]).days))
    assert got == sorted(exp)


def _rank_pct(values, p):
    v = sorted(values)
    n = len(v)
    kf, kc = math.floor(n * p), math.ceil(n * p)
    picked = [v[k - 1] for k in {kf, kc} if 1 <= k <= n]
    return sum(picked) / len(picked)


@pytest.mark.parametrize("seed", [8, 9, 10])
def test_rank_percentiles_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([1, 1, 1, 2, 3]), rnd.randint(0, 30)) for _ in range(rnd.randint(1, 400))]
    df = spark.createDataFrame(rows, "g int, v int")
    ps = {"p50": "0.5", "p80": "0.8", "p95": "0.95", "p1": "0.01"}
    got = {r["g"]: r for r in rank_percentiles(df, "g", "v", ps).collect()}
    groups = defaultdict(list)
    for g, v in rows:
        groups[g].append(v)
    from decimal import Decimal
    for g, vals in groups.items():
        for name, p in ps.items():
            # n·p in exact decimal arithmetic, as the operator does
            n = len(vals)
            pos = Decimal(n) * Decimal(p)
            kf, kc = int(pos.to_integral_value(rounding="ROUND_FLOOR")), int(pos.to_integral_value(rounding="ROUND_CEILING"))
            v = sorted(vals)
            picked = [v[k - 1] for k in sorted({kf, kc}) if 1 <= k <= n]
            assert got[g][name] == pytest.approx(sum(picked) / len(picked)), (g, name)


def _ledger(seed):
    rnd = random.Random(seed)
    return [(rnd.choice([1, 1, 2, 3]), D0 + dt.timedelta(days=rnd.randint(0, 150)), rnd.randint(-500, 500))
            for _ in range(300)]


@pytest.mark.parametrize("seed", [11, 12])
def test_month_end_and_window_sums_match_daily_spine(spark, seed):
    rows = _ledger(seed)
    df = spark.createDataFrame(rows, "c int, d date, amt long")
    end_day = max(r[1] for r in rows)
    end = F.lit(end_day)
    daily = daily_net(df, "c", "d", "amt")
    # brute force: end-of-day balance for every day from the first txn to the end
    bal = {}
    for c in {r[0] for r in rows}:
        txns = defaultdict(int)
        for r in rows:
            if r[0] == c:
                txns[r[1]] += r[2]
        day, b = min(txns), 0
        while day <= end_day:
            b += txns.get(day, 0)
            bal[(c, day)] = b
            day += dt.timedelta(days=1)
    closing = {(r["c"], r["month"]): r["closing_balance"]
               for r in month_end_balances(df, "c", "d", "amt", end).collect()}
    exp_closing = {}
    for (c, day), b in bal.items():
        m = day.replace(day=1)
        if (c, m) not in exp_closing or day > exp_closing[(c, m)][0]:
            exp_closing[(c, m)] = (day, b)
    assert closing == {k: v[1] for k, v in exp_closing.items()}
    # balance-days per month via segments == Σ daily balances of the month
    seg = balance_segments(running_balance(daily, "c", "d", "daily_net", "balance"), "c", "d", "balance", end)
    anchors = F.sequence(F.trunc("seg_start", "month"), F.trunc("seg_end", "month"), F.expr("INTERVAL 1 MONTH"))
    w = window_weighted_sum(seg, "c", "balance", F.col("month"), F.least(F.last_day("month"), end), anchors)
    got = {(r["c"], r["month"]): r["balance_days"] for r in w.collect()}
    exp = defaultdict(int)
    for (c, day), b in bal.items():
        exp[(c, day.replace(day=1))] += b
    assert got == dict(exp)


def _plain_percentile(values, p):
    """Mean of the values at ranks floor(np) and ceil(np); rank 0 does not exist."""
    v, at = sorted(values), Fraction(p) * len(values)
    lo, hi = math.floor(at), math.ceil(at)
    return float(v[hi - 1]) if lo == hi or lo == 0 else (float(v[lo - 1]) + float(v[hi - 1])) / 2


@pytest.mark.parametrize("splitters", [1, 2, 7, 1024])
@pytest.mark.parametrize("kind", ["long", "double", "decimal(30,4)", "date", "timestamp", "timestamp_ntz", "float", "int"])
def test_rank_percentiles_by_narrowing(spark, kind, splitters):
    """Wide and narrow ranges, many equal values, a hot group, a NULL group and NULL values, and groups of one row."""
    rnd = random.Random(f"{kind}{splitters}")
    values = {
        "long": lambda: rnd.choice([rnd.randint(-10**17, 10**17), rnd.randint(-5, 5), 70000]),
        "double": lambda: rnd.choice([rnd.gauss(0, 1e5), rnd.random(), -1e-300, 5e-324, 1e308, 0.0]),
        "decimal(30,4)": lambda: Decimal(rnd.randint(-10**24, 10**24)) / 10000 if rnd.random() < .7 else Decimal("1.5000"),
        "date": lambda: D0 + dt.timedelta(days=rnd.randint(-900, 900)),
        "timestamp": lambda: dt.datetime(2020, 1, 1) + dt.timedelta(microseconds=rnd.randint(-10**15, 10**15)),
        "timestamp_ntz": lambda: dt.datetime(1969, 1, 1) + dt.timedelta(microseconds=rnd.randint(0, 10**15)),
        "float": lambda: float(rnd.randint(-10**6, 10**6)) / 4,
        "int": lambda: rnd.randint(-3, 3),
    }[kind]
    rows = [(rnd.choice([1, 1, 1, 1, 2, 3, None]), None if rnd.random() < .03 else values()) for _ in range(400)] + [(9, values())]
    df = spark.createDataFrame(rows, f"g int, v {kind}")
    ps = {"p50": "0.5", "p80": "0.8", "p95": "0.95", "p1": "0.01", "p100": "1"}
    hist = df.where("v is not null").groupBy("g", "v").agg(F.count("*").alias("c"))
    out = rank_percentiles_from_histogram(hist, "g", "v", "c", ps, splitters)
    number = {"date": lambda d: (d - dt.date(1970, 1, 1)).days,
              "timestamp": lambda t: (t - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)}
    number = number.get("timestamp" if kind.startswith("timestamp") else kind, lambda v: v)
    groups = defaultdict(list)
    for g, v in rows:
        if v is not None:
            groups[g].append(number(v))
    want = {g: tuple(_plain_percentile(v, p) for p in ps.values()) for g, v in groups.items()}
    assert {r["g"]: tuple(r[n] for n in ps) for r in out.collect()} == want


def test_narrowing_bounds_the_windows_and_reads_once(spark):
    """A group of very many values: its ranked rows are a share of them, in one scan, without a job at build time."""
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), ((F.col("id") * 7919) % 1_000_003).alias("v"))
    out = rank_percentiles(df, "g", "v", {"median": "0.5"})
    rows = [r["median"] for r in out.orderBy("g").collect()]
    values = defaultdict(list)
    for i in range(200_000):
        values[i % 3].append(i * 7919 % 1_000_003)
    assert rows == [_plain_percentile(values[g], "0.5") for g in range(3)]


@pytest.mark.parametrize("seed", [15])
def test_trailing_30_day_balance_days_match_daily_spine(spark, seed):
    rows = _ledger(seed)
    df = spark.createDataFrame(rows, "c int, d date, amt long")
    end_day = max(r[1] for r in rows)
    end = F.lit(end_day)
    seg = balance_segments(running_balance(daily_net(df, "c", "d", "amt"), "c", "d", "daily_net", "balance"),
                           "c", "d", "balance", end)
    month_end = F.least(F.last_day(F.col("month")), end)
    anchors = F.sequence(F.trunc("seg_start", "month"), F.trunc(F.least(F.date_add("seg_end", 29), end), "month"),
                         F.expr("INTERVAL 1 MONTH"))
    w = window_weighted_sum(seg, "c", "balance", F.date_sub(month_end, 29), month_end, anchors)
    got = {(r["c"], r["month"]): r["balance_days"] for r in w.collect()}
    # brute force over every day
    exp = defaultdict(int)
    for c in {r[0] for r in rows}:
        txns = defaultdict(int)
        for r in rows:
            if r[0] == c:
                txns[r[1]] += r[2]
        bal, day, b = {}, min(txns), 0
        while day <= end_day:
            b += txns.get(day, 0)
            bal[day] = b
            day += dt.timedelta(days=1)
        m = min(txns).replace(day=1)
        while m <= end_day:
            nxt = (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
            me = min(nxt - dt.timedelta(days=1), end_day)
            tot = sum(bal.get(me - dt.timedelta(days=i), 0) for i in range(30))
            if any(me - dt.timedelta(days=i) in bal for i in range(30)):
                exp[(c, m)] = tot
            m = nxt
    assert got == dict(exp)


def test_distinct_bitmaps_roll_up(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(["x", "y"]), rnd.choice([rnd.randint(-70_000, 70_000), 0, 32768, None])) for _ in range(900)]
    df = spark.createDataFrame(rows, "g string, h string, i long")
    fine = distinct_bitmaps(df, ["g", "h"], "i")
    got = {(r["g"], r["h"]): r["n"] for r in bitmap_counts(fine, ["g", "h"], "n").collect()}
    assert got == {(g, h): len({i for a, b, i in rows if (a, b) == (g, h) and i is not None}) for g, h in got} and len(got) == 6
    coarse = {r["g"]: r["n"] for r in bitmap_counts(merged_bitmaps(fine, "g"), "g", "n").collect()}
    assert coarse == {g: len({i for a, _, i in rows if a == g and i is not None}) for g in ("a", "b", None)}


@pytest.mark.parametrize("seed", [31, 32])
def test_state_calendar_matches_a_daily_scan(spark, seed):
    rows = _history(seed, n=300)
    df = spark.createDataFrame(rows, "k int, d date, i int, s string").withColumn("t", F.col("d").cast("timestamp_ntz"))
    got = {(r["day"], r["s"]): r["n"] for r in state_calendar(df, "k", "t", "s", ["i"], "n").collect()}
    days = [r[1] for r in rows if r[1]]
    want, day = defaultdict(int), min(days)
    while day <= max(days):
        for rs in _by_key(rows).values():
            held = [r for r in rs if r[1] and r[1] <= day]
            if held:
                want[(day, held[-1][3])] += 1
        day += dt.timedelta(days=1)
    assert got == dict(want)


@pytest.mark.parametrize("seed", [41, 42, 43])
def test_change_events_match_accounts_times_months(spark, seed):
    """The three allocations by change events, against all days of all accounts."""
    rnd = random.Random(seed)
    rows = [(rnd.choice([1, 1, 2, 3, 4, 5]), D0 + dt.timedelta(days=int(rnd.random() ** 2 * 500)), rnd.randint(-50, 50)) for _ in range(60)]
    df = spark.createDataFrame(rows, "c int, d date, amt long")
    end = max(r[1] for r in rows) + dt.timedelta(days=rnd.choice([0, 3, 70]))
    bal = {}
    for c in {r[0] for r in rows}:
        day, b = min(r[1] for r in rows if r[0] == c), 0
        while day <= end:
            b += sum(r[2] for r in rows if r[:2] == (c, day))
            bal[c, day] = b
            day += dt.timedelta(days=1)
    months = sorted({day.replace(day=1) for _, day in bal})
    last = lambda m: min(end, (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1))
    accounts = {c for c, _ in bal}
    monthly = df.groupBy("c", F.trunc("d", "month").alias("month")).agg(F.sum("amt").alias("net"))
    levels = accumulated(level_changes(monthly, "c", "month", "net"), "month", "change", F.lit(end)).collect()
    assert {r["month"]: int(r["level"]) for r in levels} == {m: sum(max(bal.get((c, last(m)), 0), 0) for c in accounts) for m in months}
    peaks = allocation_of_peaks(month_peaks(df, "c", "d", "amt"), F.lit(end)).collect()
    opening = lambda c, m: bal.get((c, m - dt.timedelta(days=1)), 0)
    assert {r["month"]: int(r["allocation"]) for r in peaks} == {
        m: sum(max(0, opening(c, m), *[b for (a, d), b in bal.items() if a == c and m <= d <= last(m)]) for c in accounts) for m in months}
    seg = balance_segments(running_balance(daily_net(df, "c", "d", "amt"), "c", "d", "daily_net", "b"), "c", "d", "b", F.lit(end))
    for width in (30, 7):
        parts = trailing_changes(seg, "c", "b", width, F.lit(end))
        out = accumulated(parts, "month", "change", F.lit(end), {"own": F.sum(F.greatest("own", F.lit(0)))}).collect()
        got = {r["month"]: int(r["level"]) + (r["own"] or 0) for r in out}
        want = {m: sum(max(0, sum(bal.get((c, last(m) - dt.timedelta(days=k)), 0) for k in range(width))) for c in accounts) for m in months}
        assert {m: got.get(m, 0) for m in months} == want


def test_ordered_list_in_slices_equals_one_list(spark):
    rnd = random.Random(51)
    rows = [(rnd.choice(["hot", "hot", "a", None]), rnd.randint(0, 50), f"i{rnd.randint(0, 300)}") for _ in range(700)]
    df = spark.createDataFrame(rows, "g string, o int, i string").repartition(5)
    want = {r["g"]: r["items"] for r in ordered_list(df, "g", "i", "o", "; ").collect()}
    for slices in (1, 4, 60):
        out = ordered_list_in_slices(df, "g", "i", "o", "; ", slices=slices)
        assert {r["g"]: r["items"] for r in out.collect()} == want
    dealt = df.repartitionByRange(20, "g", "o").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in dealt) < 700 / 20 * 2.5  # the hot group is no task of its own


@pytest.mark.parametrize("shares", [(0.4, 0.4), (0.4, 0.0), (0.0, 0.4), (0.0, 0.0)])
def test_salted_full_outer_merge_equals_the_plain_join(spark, shares):
    rnd = random.Random(str(shares))
    side = lambda share, n, name: [(*((1, "hot") if rnd.random() < share else (rnd.randint(2, 40) if rnd.random() < .9 else None, "k")), f"{name}{i}")
                                   for i in range(n)]
    left = spark.createDataFrame(side(shares[0], 150, "l"), "a int, b string, x string")
    right = spark.createDataFrame(side(shares[1], 120, "r"), "a int, b string, y string")
    want = sorted(map(str, left.join(right, ["a", "b"], "full_outer").collect()))
    for hot_share in (0.02, 0.2, 2.0):
        assert sorted(map(str, salted_full_outer_merge(left, right, ["a", "b"], hot_share).collect())) == want
    none = left.where("false")
    assert salted_full_outer_merge(none, right, ["a", "b"]).count() == right.count()
    assert salted_full_outer_merge(none, none.withColumnRenamed("x", "y"), ["a", "b"]).count() == 0


def test_salted_full_outer_merge_splits_a_hot_key(spark):
    """A third of both sides: the cells of the grid are alike."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    merged = salted_full_outer_merge(df.withColumnRenamed("id", "x"), df.withColumnRenamed("id", "y"), "k", 0.1)
    assert merged.count() == 1_000_000 + 2000
    cell = lambda c: F.pmod(F.xxhash64(c, "k"), F.lit(8))
    cells = sorted(r["count"] for r in merged.where("k = -1").groupBy(cell("x"), cell("y")).count().collect())
    assert len(cells) == 64 and cells[-1] <= 2 * cells[32]
