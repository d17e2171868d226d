import datetime as dt
from decimal import Decimal

from fixtures import PAYMENTS_EXPECTED, PLANS, SUBSCRIPTIONS_SAMPLE, load, rows

from tallyframe.operators.billing import payment_schedule


def test_published_payments_example(spark):
    subs, plans = load(spark, SUBSCRIPTIONS_SAMPLE), load(spark, PLANS)
    got = payment_schedule(subs, plans, dt.date(2020, 1, 1), dt.date(2020, 12, 31))
    expected = sorted((c, p, n, dt.date.fromisoformat(d), Decimal(a).quantize(Decimal("0.01")), o)
                      for c, p, n, d, a, o in PAYMENTS_EXPECTED)
    assert rows(got, "customer_id", "plan_id", "plan_name", "payment_date", "amount", "payment_order") == expected


def test_month_end_anchor_does_not_drift(spark):
    from tallyframe.sources.literal import frame
    subs = frame(spark, "customer_id int, plan_id int, start_date date", [(1, 1, "2020-01-31")])
    got = payment_schedule(subs, load(spark, PLANS), dt.date(2020, 1, 1), dt.date(2020, 4, 30))
    assert [r[0] for r in rows(got, "payment_date")] == [
        dt.date(2020, 1, 31), dt.date(2020, 2, 29), dt.date(2020, 3, 31), dt.date(2020, 4, 30)]


def test_old_rows_expand_only_over_the_period(spark):
    from tallyframe.sources.literal import frame
    subs = frame(spark, "customer_id int, plan_id int, start_date date",
                 [(1, 1, "2015-01-31"), (2, 2, "2019-12-15"), (2, 4, "2020-03-10"), (3, 3, "2017-06-30")])
    got = payment_schedule(subs, load(spark, PLANS), dt.date(2020, 1, 1), dt.date(2020, 12, 31))
    r = rows(got, "customer_id", "payment_date", "payment_order")
    c1 = [x for x in r if x[0] == 1]
    assert [x[1] for x in c1] == [dt.date(2020, m, d) for m, d in
                                  [(1, 31), (2, 29), (3, 31), (4, 30), (5, 31), (6, 30), (7, 31), (8, 31),
                                   (9, 30), (10, 31), (11, 30), (12, 31)]]
    assert [x[2] for x in c1] == list(range(1, 13))
    assert [x[1:] for x in r if x[0] == 2] == [(dt.date(2020, 1, 15), 1), (dt.date(2020, 2, 15), 2)]
    assert [x[1:] for x in r if x[0] == 3] == [(dt.date(2020, 6, 30), 1)]
