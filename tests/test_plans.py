"""Plan checks for every registered query: no nested-loop or cartesian join,
no Python evaluation, and parquet scans read only the columns they use."""

import re

import pytest

import __spark_entry__ as E
from tallyframe.plans import delivery_queries
from tallyframe.plans.catalogue import QUERIES
from tallyframe.sources.tables import SCHEMAS

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    df = E.queries()[name](spark, SF)
    plan = _plan(df)
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    # No un-partitioned window (it would pull every row into one task).
    # (its spec starts with an ordering or the frame, not a partition column)
    assert not re.search(r"windowspecdefinition\((?:[^,()]+ (?:ASC|DESC)|specifiedwindowframe)", plan), \
        f"{name}: global window"
    # Column pruning: no scan of the wide tables reads every column.
    for table, n_cols in (("lineitem", 11), ("orders", 6), ("events", 6)):
        for m in re.finditer(rf"FileScan parquet \[([^\]]*)\][^\n]*{table}\.parquet", plan):
            assert len(m.group(1).split(",")) < n_cols, f"{name}: reads all of {table}"


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def _exchanges(df):
    return re.findall(r"[ +-]Exchange ([^\n]*)", _plan(df).split("Initial Plan")[0])


@pytest.mark.parametrize("name", ["order_change_labels", "order_word_lists"])
def test_words_are_spread_out_behind_the_last_exchange(spark, no_broadcast, name):
    df = E.queries()[name](spark, SF)
    assert len(_exchanges(df)) <= 4


@pytest.fixture
def shop(spark, tmp_path):
    """Orders of two lines over parts of three words, one of which stands twice in the name."""
    n = 300
    rows = {"part": [(i, f"word{i % 7} bolt word{i % 7} ring{i % 3}", "b", f"type{i % 4}", 1, 1.0) for i in range(50)],
            "orders": [(i, i % 9, "F", 1.0, None, f"{i % 5}-PRIO") for i in range(n)],
            "lineitem": [(i // 2, i % 50, 1, i % 2, 1.0, 1.0, 0.0, 0.0, "RAN"[i % 3], "F", None) for i in range(2 * n)]}
    for name, r in rows.items():
        spark.createDataFrame(r, SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["order_change_labels", "order_word_lists"])
def test_tasks_of_words_grow_in_number(spark, no_broadcast, monkeypatch, shop, name):
    """A task spreads out a bounded number of words, and the rows stay as they are."""
    want = sorted(map(tuple, E.queries()[name](spark, shop).collect()))
    monkeypatch.setattr(delivery_queries, "WORDS_A_TASK", 40, raising=False)  # 400 lines of 3 words are taken
    df = E.queries()[name](spark, shop)
    dealt = [x for x in _exchanges(df) if "l_orderkey" in x and "REPARTITION_BY_NUM" in x]
    assert dealt and all(int(re.search(r", (\d+)\), REPARTITION_BY_NUM", x).group(1)) >= 30 for x in dealt)
    assert len(_exchanges(df)) <= 4 and sorted(map(tuple, df.collect())) == want and len(want) > 100


def test_bucketed_tables_meet_where_they_lie(spark, no_broadcast):
    keys = _exchanges(E.queries()["order_detail_bucketed"](spark, SF))
    assert keys and not any("orderkey" in k or "order_id" in k for k in keys)


def _jobs(spark, run):
    """How many jobs ``run`` starts."""
    before = spark.sparkContext.range(1).count() and max(spark.sparkContext.statusTracker().getJobIdsForGroup(None), default=0)
    run()
    spark.sparkContext.range(1).count()
    return max(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before - 1


@pytest.mark.parametrize("name", ["payment_schedule", "state_change_gap_percentiles", "allocation_trailing_30d"])
def test_building_starts_no_job(spark, name):
    assert _jobs(spark, lambda: E.queries()[name](spark, SF)) == 0


def test_payments_are_numbered_in_one_read(spark, no_broadcast):
    df = E.queries()["payment_schedule"](spark, SF)
    df.collect()
    plan = _plan(df).split("Initial Plan")[0]
    assert "ReusedExchange" in plan and len(re.findall("FileScan parquet", plan)) == 2  # the neighbours' rows and edges


def test_no_stage_holds_accounts_times_months(spark):
    """No per-account calendar: the only sequences made are those of the totals and of the month ends near a change."""
    for name in ("allocation_prev_month_end", "allocation_realtime"):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("explode(sequence(") == 1 and "_all" in plan, name
