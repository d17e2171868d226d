from collections import defaultdict

import numpy as np
import pytest
from cases import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm.packing import CAPACITIES, cost, pack, packed_pieces


def check_bins(lengths, owner, capacity, caps):
    used = np.bincount(owner, lengths, len(capacity)).astype(int)
    assert (used <= capacity).all() and set(capacity.tolist()) <= set(caps)
    for u, c in zip(used, capacity, strict=True):
        assert c == min(x for x in caps if x >= u)  # downsized to its contents


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=60))
def test_pack_holds_everything_once(lengths):
    lengths, caps = np.array(lengths), (10, 20, 40)
    owner, capacity = pack(lengths, caps)
    check_bins(lengths, owner, capacity, caps)


def test_best_fit_and_least_cost_opening():
    owner, capacity = pack(np.array([30, 25, 10, 15]), (40,))
    assert owner[0] == owner[2] and owner[1] == owner[3] and capacity.tolist() == [40, 40]
    owner, capacity = pack(np.array([9]), (10, 20, 40))
    assert capacity.tolist() == [10]
    r = np.random.default_rng(1)
    lengths = np.minimum(CAPACITIES[-1], r.lognormal(5.5, 1.2, 20_000).astype(int) + 1)
    owner, capacity = pack(lengths)
    joint = cost(capacity).sum()
    assert lengths.sum() / capacity.sum() > 0.99
    assert joint < cost(pack(lengths, CAPACITIES[-1:])[1]).sum()  # better than the longest length alone


def single(lengths, capacity):
    """Cost of best fit with one capacity, bins downsized."""
    bins = []
    for n in sorted(lengths.tolist(), reverse=True):
        fit = [b for b in bins if b[0] >= n]
        b = min(fit, default=None)
        if b is None:
            b = [max(capacity, min(c for c in CAPACITIES if c >= n)), 0]
            bins.append(b)
        b[0] -= n
        b[1] += n
    return sum(cost(min(c for c in CAPACITIES if c >= used)) for _, used in bins)


@pytest.mark.parametrize("kind", ["600", "1100", "520-700", "lognormal", "small", "halves"])
def test_never_dearer_than_any_single_length(kind):
    r = np.random.default_rng(2)
    lengths = {
        "600": lambda: np.full(600, 600), "1100": lambda: np.full(600, 1100), "520-700": lambda: r.integers(520, 701, 1500),
        "lognormal": lambda: np.clip(r.lognormal(7, 0.5, 1500).astype(int), 1, 4096), "small": lambda: r.integers(1, 90, 1500),
        "halves": lambda: r.choice([300, 2049, 1500, 513], 900),
    }[kind]()
    owner, capacity = pack(lengths)
    check_bins(lengths, owner, capacity, CAPACITIES)
    assert cost(capacity).sum() <= min(single(lengths, c) for c in CAPACITIES) + 1e-6


def cheapest(lengths, caps):
    """Least cost over all ways to put the pieces into bins."""
    best = [float("inf")]

    def place(i, bins):
        if i == len(lengths):
            best[0] = min(best[0], sum(cost(min(c for c in caps if c >= b)) for b in bins))
            return
        for j in range(len(bins)):
            if bins[j] + lengths[i] <= max(caps):
                place(i + 1, [*bins[:j], bins[j] + lengths[i], *bins[j + 1 :]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best[0]


def test_small_sets_against_all_ways():
    r, over = np.random.default_rng(4), []
    for _ in range(150):
        caps = (64, 128, 256)
        lengths = r.integers(1, 257, r.integers(1, 8))
        owner, capacity = pack(lengths, caps)
        check_bins(lengths, owner, capacity, caps)
        over.append(float(cost(capacity).sum()) / cheapest(lengths.tolist(), caps))
    assert np.mean(over) < 1.03 and max(over) < 1.35 and min(over) >= 1 - 1e-9


def test_odd_rows_every_word_once(spark):
    docs = documents(spark, clashing=True)
    out = packed_pieces(docs, capacities=(8, 16, 64), shard_pieces=50).collect()
    words = defaultdict(int)
    for r in docs.collect():
        words[r["doc_id"]] += len((r["text"] or "").encode().split())
    got, bins, starts = defaultdict(int), defaultdict(list), defaultdict(list)
    for r in out:
        got[r["id"]] += r["length"]
        if r["length"]:
            bins[r["shard"], r["bin"], r["capacity"]].append((r["position"], r["length"]))
            starts[r["id"]].append((r["start"], r["length"]))
        else:
            assert r["bin"] is None
    assert got == words
    for (_, _, capacity), parts in bins.items():
        at = 0
        for position, length in sorted(parts):
            assert position == at
            at += length
        assert capacity == min(c for c in (8, 16, 64) if c >= at)
    at = 0
    for start, length in sorted(starts[7]):
        assert start == at
        at += length
    assert packed_pieces(documents(spark, [])).count() == 0
    assert packed_pieces(documents(spark, [(1, None, "en", "s", 0)])).count() == 1
