import random
from collections import defaultdict

import numpy as np
import pytest
from cases import documents

from tallyframe.llm.mixing import fit_counts, mix_sources, mixed


def best_sum(lengths, counts, budget):
    reach = 1
    for length, n in zip(lengths, counts, strict=True):
        for _ in range(n):
            reach |= reach << length
    return max(i for i in range(budget + 1) if reach >> i & 1)


def test_fit_counts_is_the_best_subset_sum_within_its_window():
    r = np.random.default_rng(1)
    for _ in range(150):
        k = int(r.integers(1, 12))
        lengths = np.sort(r.choice(np.arange(1, 90), k, replace=False))
        counts = r.integers(1, 3, k)
        budget = int(r.integers(0, (lengths * counts).sum() + 1))
        take = fit_counts(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        got, best = int((lengths * take).sum()), best_sum(lengths.tolist(), counts.tolist(), budget)
        assert got <= budget and best - got <= (0 if budget <= 8 * lengths[-1] else 2)


def test_fit_counts_hits_large_budgets_exactly():
    lengths, counts = np.arange(1, 4000), np.random.default_rng(2).integers(1, 50, 3999)
    budget = int((lengths * counts).sum() * 0.37)
    assert int((lengths * fit_counts(lengths, counts, budget)).sum()) == budget


def plain_targets(sizes):
    order = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, got, free = 1.5 * sum(sizes.values()), dict.fromkeys(sizes, 0.0), set(sizes)
    rest = total
    while rest > 1e-9 and free:
        w = sum(weight[s] for s in free)
        for s in free:
            got[s] += rest * weight[s] / w
        rest = sum(max(0.0, got[s] - 2 * sizes[s]) for s in sizes)
        for s in sizes:
            got[s] = min(got[s], 2.0 * sizes[s])
        free = {s for s in free if got[s] < 2 * sizes[s]}
    return got


def test_targets_and_taken_against_a_plain_version(spark):
    r = random.Random(3)
    rows = [(i, " ".join("w" * r.randint(1, 3) for _ in range(r.randint(0, 40))), "en",
             r.choice([None, "b", "a", "ü", "z"] + ["hot"] * 5), 0) for i in range(900)]
    out = mixed(documents(spark, rows)).collect()
    again = mixed(documents(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))
    source = {x[0]: x[3] for x in rows}
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    assert {x["id"]: x["size"] for x in out} == {x[0]: len(x[1].split()) for x in rows}
    for x in out:
        s = source[x["id"]]
        sizes[s] += x["size"]
        taken[s] += x["taken"]
        target[s] = x["target"]
        assert 0 <= x["taken"] <= 2 * x["size"] and x["taken"] == x["copies"] * x["size"]
    want = plain_targets(dict(sizes))
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 1


def test_odd_rows_whole_rows_and_clashing_names(spark):
    docs = documents(spark, clashing=True)
    copies = {}
    for x in mixed(docs).collect():
        copies[x["id"]] = copies.get(x["id"], 0) + x["copies"]
    out = mix_sources(docs)
    assert out.columns == docs.columns
    seen = {}
    for x in out.collect():
        seen[x["doc_id"]] = seen.get(x["doc_id"], 0) + 1
    assert seen == {k: v for k, v in copies.items() if v}


def test_empty_table(spark):
    docs = documents(spark, [])
    assert mixed(docs).count() == 0 and mix_sources(docs).count() == 0
    assert mixed(documents(spark, [(1, None, "en", "a", 0), (2, "", "en", None, 0)])).agg({"taken": "sum"}).first()[0] == 0
