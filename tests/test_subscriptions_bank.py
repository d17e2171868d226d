import datetime as dt

import pytest
from fixtures import CUSTOMER_NODES_1, PLANS, REGIONS, SUBSCRIPTIONS_SAMPLE, TRANSACTIONS_1, load, rows

from tallyframe.plans import bank as B
from tallyframe.plans import subscriptions as S


@pytest.fixture(scope="module")
def subs(spark):
    return load(spark, SUBSCRIPTIONS_SAMPLE)


def test_subscription_counts(spark, subs):
    plans = load(spark, PLANS)
    assert rows(S.customer_count(subs)) == [(7,)]
    assert rows(S.starts_after_year(subs, plans)) == [("pro monthly", 1)]
    assert rows(S.churn_rows_literal(subs)) == [(1, 5.6)]  # 1 of 18 rows
    assert rows(S.churned_customers(subs)) == [(1, 14.3)]
    assert rows(S.churn_without_paying(subs)) == [(0, 0.0)]
    assert rows(S.annual_upgrades_in_year(subs, plans)) == [(3,)]
    assert rows(S.basic_starts_in_year_literal(subs)) == [(3,)]
    assert rows(S.downgrades_in_year(subs)) == [(0,)]


def test_as_of_and_trial_to_annual(spark, subs):
    plans = load(spark, PLANS)
    held = {r[0]: r[1] for r in rows(S.plan_breakdown_as_of(subs, plans, dt.date(2020, 12, 31)), "plan_id", "customers")}
    assert held == {1: 2, 2: 1, 3: 3, 4: 1}
    assert rows(S.plan_breakdown_on_date_literal(subs)) == []
    # trial → annual: customer 2 (7 days), 16 (143 days), 19 (68 days)
    assert rows(S.avg_days_to_annual(subs))[0][0] == pytest.approx((7 + 143 + 68) / 3)
    assert rows(S.days_to_annual_buckets(subs), "period", "customers") == sorted(
        [("0-30 days", 1), ("61-90 days", 1), ("121-150 days", 1)])


def test_node_gaps_and_percentiles(spark):
    nodes, regions = load(spark, CUSTOMER_NODES_1), load(spark, REGIONS)
    assert rows(B.unique_nodes(nodes)) == [(4,)]
    assert rows(B.reallocation_gaps(nodes), "diff") == [(2,), (11,), (12,), (21,)]
    assert rows(B.avg_reallocation_days(nodes)) == [("11.5 days",)]
    assert rows(B.reallocation_percentiles(nodes)) == [(3, 11.0, 16.5, 16.5)]
    assert rows(B.customers_per_region(nodes, regions)) == [(3, "Africa", 1)]


def test_ledger_customer_1(spark):
    txns = load(spark, TRANSACTIONS_1)
    closing = rows(B.closing_balances(txns), "month", "closing_balance")
    assert [c for _, c in closing] == [312, 312, -640]
    assert rows(B.running_balances(txns), "txn_date", "running_balance") == [
        (dt.date(2020, 1, 2), 312), (dt.date(2020, 3, 5), -300), (dt.date(2020, 3, 17), 24),
        (dt.date(2020, 3, 19), -640)]
    assert rows(B.running_balance_stats(txns)) == [(1, -640, pytest.approx(-151.0), 312)]
    opt1 = rows(B.data_needed_option1(txns))
    assert [v for _, v in opt1] == [312, 312]
    # simple interest: 312 for Jan 2-31 (30 days) at 6%/365
    jan = rows(B.daily_interest_per_month(txns))[0]
    assert jan[0] == dt.date(2020, 1, 1) and jan[1] == pytest.approx(312 * 30 * 0.06 / 365)


def test_more_subscription_views(spark, subs):
    from tallyframe.sources.literal import frame
    plans = load(spark, PLANS)
    sample = frame(spark, "customer_id int", [(1,), (2,)])
    assert rows(S.journeys(subs, plans, sample), "customer_id", "plan_name") == [
        (1, "basic monthly"), (1, "trial"), (2, "pro annual"), (2, "trial")]
    assert dict(rows(S.trial_starts_per_month_literal(subs))) == {3: 1, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1, 12: 1}
    assert rows(S.plans_after_trial_literal(subs))[0][0] == 11


def test_more_ledger_views(spark):
    txns = load(spark, TRANSACTIONS_1)
    assert rows(B.type_summary(txns)) == [("deposit", 2, 636), ("purchase", 2, 1276)]
    assert rows(B.avg_deposits(txns)) == [(2.0, 636.0)]
    assert rows(B.active_customers_per_month(txns)) == []
    assert rows(B.growing_customers_share(txns)) == [(0, 0.0)]
    opt2 = {m: v for m, v in rows(B.data_needed_option2(txns))}
    assert [float(v) for _, v in sorted(opt2.items())] == [312.0, 312.0, 0.0]
    opt3 = [v for _, v in rows(B.data_needed_option3(txns))]
    assert opt3 == [312, 312, 312]


def test_more_delivery_views(spark):
    from fixtures import CUSTOMER_ORDERS, PIZZA_NAMES, PIZZA_RECIPES, PIZZA_TOPPINGS, RUNNER_ORDERS, RUNNERS
    from tallyframe.plans import delivery as D
    shop = D.Shop(*(load(spark, t) for t in (RUNNERS, CUSTOMER_ORDERS, RUNNER_ORDERS, PIZZA_NAMES,
                                             PIZZA_RECIPES, PIZZA_TOPPINGS)))
    got = {c: v for c, v in rows(D.avg_distance_per_customer(shop))}
    assert got == pytest.approx({101: 20.0, 102: 18.4, 103: 23.4, 104: 10.0, 105: 25.0})
    per_runner = {r: v for r, v in rows(D.avg_minutes_to_pickup_per_runner(shop))}
    assert per_runner == pytest.approx({1: 14.0, 2: 59 / 3, 3: 10.0})
    speeds = {o: v for _, o, v in rows(D.speed_per_delivery(shop))}
    assert speeds[1] == pytest.approx(37.5) and len(speeds) == 8


def test_compound_interest_grows_day_by_day(spark):
    more = [(2, "2020-01-31", "deposit", 100), (2, "2020-02-10", "withdrawal", 40)]
    txns = load(spark, (TRANSACTIONS_1[0], [*TRANSACTIONS_1[1], *more]))
    nets, g = {}, 1 + 0.06 / 365
    for r in txns.collect():
        nets.setdefault(r["customer_id"], {}).setdefault(r["txn_date"], 0)
        nets[r["customer_id"]][r["txn_date"]] += r["txn_amount"] * (1 if r["txn_type"] == "deposit" else -1)
    want = {}
    for days in nets.values():
        day, b = min(days), 0.0
        while day <= dt.date(2020, 3, 31):
            b += days.get(day, 0)
            want[day.replace(day=1)] = want.get(day.replace(day=1), 0) + b * (g - 1)
            b, day = b * g, day + dt.timedelta(days=1)
    assert {r["month"]: r["interest"] for r in B.compound_interest_per_month(txns).collect()} == pytest.approx(want)
