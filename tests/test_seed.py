"""Published values over the whole seed.

The seed scripts are read as text from the folder that ``TALLYFRAME_SEED_DIR`` names; without it these tests are skipped.
"""

import os
import pathlib
import re

import pytest
from fixtures import PAYMENTS_EXPECTED, rows

from tallyframe.plans import bank as B
from tallyframe.plans import subscriptions as S
from tallyframe.sources.literal import frame

FOLDER = os.environ.get("TALLYFRAME_SEED_DIR")
pytestmark = pytest.mark.skipif(not FOLDER, reason="TALLYFRAME_SEED_DIR is not set")

DDL = {
    "plans": "plan_id int, plan_name string, price decimal(5,2)",
    "subscriptions": "customer_id int, plan_id int, start_date date",
    "regions": "region_id int, region_name string",
    "customer_nodes": "customer_id int, region_id int, node_id int, start_date date, end_date date",
    "customer_transactions": "customer_id int, txn_date date, txn_type string, txn_amount int",
}
ROW = re.compile(r"\(((?:'(?:[^']|'')*'|[^'()])*)\)")
FIELD = re.compile(r"'((?:[^']|'')*)'|([^,\s]+)")


@pytest.fixture(scope="module")
def seed(spark):
    found = {}
    for path in sorted(pathlib.Path(FOLDER).rglob("*.sql")):
        text = path.read_text()
        for m in re.finditer(r"INSERT\s+INTO\s+(\w+)\s*\([^)]*\)\s*VALUES(.*?);", text, re.S | re.I):
            if m[1] in DDL:
                data = [tuple(None if bare and bare.lower() == "null" else bare or said for said, bare in FIELD.findall(row))
                        for row in ROW.findall(m[2])]
                found[m[1]] = frame(spark, DDL[m[1]], data)
    return found


def test_nodes(seed):
    nodes, regions = seed["customer_nodes"], seed["regions"]
    assert rows(B.unique_nodes(nodes)) == [(5,)]
    assert [n for *_, n in rows(B.nodes_per_region(nodes, regions))] == [5] * 5
    assert [n for *_, n in rows(B.customers_per_region(nodes, regions))] == [110, 105, 102, 95, 88]
    assert rows(B.avg_reallocation_days(nodes)) == [("15.6 days",)]
    assert B.reallocation_gaps(nodes).count() == 2393
    assert rows(B.reallocation_percentiles(nodes)) == [
        (1, 15, 24, 29), (2, 16, 24, 29), (3, 16, 25, 29), (4, 15, 24, 29), (5, 16, 26, 29)]


def test_subscriptions(seed):
    subs, plans = seed["subscriptions"], seed["plans"]
    assert rows(S.customer_count(subs)) == [(1000,)]
    assert [n for _, n in rows(S.trial_starts_per_month_literal(subs))] == [88, 68, 94, 81, 88, 79, 89, 88, 87, 79, 75, 84]
    assert rows(S.starts_after_year(subs, plans)) == [("basic monthly", 8), ("churn", 71), ("pro annual", 63), ("pro monthly", 60)]
    assert rows(S.churn_rows_literal(subs)) == [(307, 11.6)]
    assert rows(S.churn_without_paying(subs)) == [(92, pytest.approx(9.2))]
    assert rows(S.annual_upgrades_in_year(subs, plans)) == [(195,)]
    assert rows(S.avg_days_to_annual(subs))[0][0] == pytest.approx(26992 / 258)
    assert rows(S.avg_periods_to_annual_literal(subs))[0][0] == pytest.approx(26992 / 258 / 30)
    assert rows(S.basic_starts_in_year_literal(subs)) == [(538,)]


def test_payments(seed):
    customers = {r[0] for r in PAYMENTS_EXPECTED}
    paid = S.payments(seed["subscriptions"], seed["plans"])
    got = [(*r[:3], str(r[3]), str(r[4]), r[5]) for r in rows(paid.where(paid.customer_id.isin(customers)))]
    assert got == sorted(PAYMENTS_EXPECTED)


def test_three_allocations_add_up(seed):
    """Over the whole ledger: the highest balance of a month is no less than the closing balance of the month before."""
    txns = seed["customer_transactions"]
    before, peak = (dict(rows(x)) for x in (B.data_needed_option1(txns), B.data_needed_option3(txns)))
    assert txns.count() == 5868 and before and all(peak[m] >= v for m, v in before.items())
    simple, compound = (dict(rows(x)) for x in (B.daily_interest_per_month(txns), B.compound_interest_per_month(txns)))
    assert simple.keys() == compound.keys() and all(abs(compound[m] - simple[m]) < 0.05 * abs(simple[m]) + 5 for m in simple)
