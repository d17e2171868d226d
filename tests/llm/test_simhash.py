import random

import numpy as np
import pytest
import xxhash
from cases import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm.components import components
from tallyframe.llm.simhash import _stars, anchors, fingerprint, fingerprints, linked, near_dedup, near_duplicates


def plain_fingerprint(text):
    words = text.lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)).to_bytes(8, "big")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"B", b"b", "é".encode(), "É".encode(), b" ", b"\n", b"\x0b", b"\x1c"]), max_size=40).map(b"".join))
def test_fingerprint_against_a_plain_version(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_long_texts():
    r = random.Random(1)
    text = b" ".join(r.choice([b"x", b"y", b"zz"]) for _ in range(40_000))
    assert fingerprint(text) == plain_fingerprint(text)


def test_jvm_hash_is_the_same(spark):
    from pyspark.sql import functions as F
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_linked_fingerprints_meet_at_an_anchor():
    r = np.random.default_rng(0)
    x = r.integers(0, 2**64, 4000, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in r.choice(64, i % 4, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    row_x, point_x, home = anchors(x)
    row_y, point_y, _ = anchors(y)
    homes = set(zip(row_x[home].tolist(), point_x[home].tolist(), strict=True))
    assert {i for i, p in zip(row_y.tolist(), point_y.tolist(), strict=True) if (i, p) in homes} == set(range(len(x)))


def plain_components(fp):
    values = np.array(fp, np.uint64)
    label = list(range(len(values)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3):
            a, b = sorted((top(i), top(int(j))))
            label[b] = a
    return [top(i) for i in range(len(values))]


def test_links_lose_nothing(spark):
    r = random.Random(7)
    fps = {r.getrandbits(64) for _ in range(300)}
    for center in [r.getrandbits(64) for _ in range(3)]:  # a dense group and chains
        for _ in range(150):
            center ^= 1 << r.randrange(64)
            fps.add(center)
            fps.add(center ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    fps = sorted(fps)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    roots = {r["node"]: r["root"] for r in components(linked(spark.createDataFrame([(x,) for x in signed], "fp long"))).collect()}
    got = [roots.get(x, x) for x in signed]
    want = plain_components(fps)
    assert len(set(got)) == len(set(want)) and all((got[i] == got[w]) for i, w in enumerate(want))
    with pytest.raises(ValueError):
        linked(spark.createDataFrame([(1,)], "fp long"), 4)


def test_components_of_chain_star_and_nothing(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1001 + i) for i in range(50)] + [(5000, 5000), (3000, 3001), (3001, 3000)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({found[i] for i in range(n + 1)}) == 1 and len({found[1000 + i] for i in range(51)}) == 1
    assert len(set(found.values())) == 3 and found[3000] == found[3001]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    a, b = _stars(np.array([5, 3, 9]), np.array([3, 1, 8]))
    assert dict(zip(a.tolist(), b.tolist(), strict=True)) == {5: 1, 3: 1, 9: 8}


def plain_groups(rows):
    fp = [int.from_bytes(plain_fingerprint((r[1] or "").encode()), "big") for r in rows]
    comp = plain_components(fp)
    least = {}
    for r, c in zip(rows, comp, strict=True):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    return [(r[0], f"{f:016x}", least.get(c)) for r, f, c in zip(rows, fp, comp, strict=True)]


def test_odd_rows_and_near_copies(spark):
    docs = documents(spark)
    rows = [tuple(r) for r in docs.collect()]
    r = random.Random(5)
    base = [r.choice("abcdefghij") * r.randint(1, 4) for _ in range(300)]
    for i in range(60):  # near copies, a third exact
        words = list(base)
        if i % 3:
            words[r.randrange(300)] = "changed"
        rows.append((100 + i, " ".join(words), "en", "s", 0))
    out = near_duplicates(documents(spark, rows)).collect()
    got = sorted(((x["id"], f"{x['fp'] % 2**64:016x}", x["component_id"]) for x in out), key=str)
    assert got == sorted(plain_groups(rows), key=str)
    kept = near_dedup(documents(spark, rows, clashing=True))
    assert kept.count() == len({c for _, _, c in plain_groups(rows) if c is not None}) + len({f for i, f, c in plain_groups(rows) if c is None})
    assert kept.columns == documents(spark, clashing=True).columns


def test_empty_table(spark):
    docs = documents(spark, [])
    assert fingerprints(docs).count() == 0 and near_duplicates(docs).count() == 0 and near_dedup(docs).count() == 0
