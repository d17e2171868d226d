import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import queries as Q
from tallyframe.llm.vector_codes import books_sha256, cuts, decoded, neighbour_lists, orchard, vector_codes, whole_numbers

SCHEMA = "vec_id long, embedding array<float>, label int"


def nearest(query, book):
    """(entry, squared distance), all entries compared."""
    return min((sum((a - b) ** 2 for a, b in zip(query, entry, strict=True)), i) for i, entry in enumerate(book))[::-1]


def plain(rows, parts=8, entries=16, rounds=6):
    """The contract in plain Python integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [[math.floor(np.float32(x).item() * 4096) for x in r[1]] for r in kept]
    by_id = {}
    for r, v in zip(kept, whole, strict=True):
        by_id.setdefault(r[0], []).append(v)
    order = sorted(by_id, key=lambda i: (i is None, i or 0))[:entries]
    books, spans = [], cuts(len(whole[0]) if whole else 0, parts)
    for span in spans:
        book = [min(by_id[i])[span] for i in order]
        for _ in range(rounds):
            won = [nearest(v[span], book)[0] for v in whole]
            for e in range(len(book)):
                mine = [v[span] for v, w in zip(whole, won, strict=True) if w == e]
                if mine:
                    book[e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
        books.append(book)
    out, labels = [], {}
    for r, v in zip(kept, whole, strict=True):
        found = [nearest(v[s], b) for s, b in zip(spans, books, strict=True)]
        out.append([r[0], r[2], "".join(f"{e:02x}" for e, _ in found), sum(d for _, d in found)])
        labels[r[2]] = labels.get(r[2], 0) + out[-1][3]
    digest = hashlib.sha256(",".join(str(x) for b in books for y in b for x in y).encode()).hexdigest()
    return sorted(((*o, labels[o[1]]) for o in out), key=str), digest


def found(spark, rows, **options):
    codes, books = vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(3), **options)
    return sorted((tuple(r) for r in codes.collect()), key=str), books_sha256(books)


def made(n, width, seed=1, spread=1.0):
    r = random.Random(seed)
    return [(i, [r.gauss(0, spread) for _ in range(width)], r.choice([None, 1, 2])) for i in range(n)]


@pytest.mark.parametrize("wide", [False, True])
def test_orchard_finds_the_nearest(wide):
    r = np.random.default_rng(3)
    for entries, width, reach in ((1, 3, 5), (2, 1, 3), (16, 8, 2), (16, 2, 4), (40, 3, 100), (7, 0, 1)):
        numbers = lambda n: r.integers(-reach, reach + 1, (n, width)).astype(object if wide else np.int64)  # noqa: B023, E731
        book, queries = numbers(entries), numbers(300)  # many ties, equal entries among them
        best, dist = orchard(queries, book, neighbour_lists(book))
        assert [(int(b), int(d)) for b, d in zip(best, dist, strict=True)] == [nearest(q, book) for q in queries.tolist()]


def test_orchard_passes_entries_by(monkeypatch):
    """Groups of entries far apart: once a query is near its group, the walk stops after it."""
    r = np.random.default_rng(5)
    centres = r.integers(-10**6, 10**6, (8, 4))
    book = np.concatenate([c + r.integers(-20, 20, (8, 4)) for c in centres])
    near, apart = neighbour_lists(book)
    looked = np.zeros(400, int)

    class Counted(np.ndarray):
        def __getitem__(self, key):
            out = super().__getitem__(key)
            if out.ndim == 2 and out.shape[1] == 4:
                np.add.at(looked, np.asarray(key), 1)
            return out

    queries = centres[r.integers(0, 8, 400)] + r.integers(-15, 15, (400, 4))
    best, _ = orchard(queries.view(Counted), book, (near, apart))
    assert best.tolist() == [nearest(q, book.tolist())[0] for q in queries.tolist()]
    assert looked.max() <= 64 and looked.mean() < 48


def test_against_plain(spark):
    rows = made(300, 16) + [(5, made(1, 16, 9)[0][1], 1), (None, made(1, 16, 8)[0][1], 2)] * 2
    rows += [(900, None, 1), (901, [1.0] * 15 + [None], 1), (902, [float("nan")] + [1.0] * 15, None), (903, [float("-inf")] * 16, 2)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows, parts=3, entries=5, rounds=2) == plain(rows, 3, 5, 2)


def test_few_equal_and_no_vectors(spark):
    few = made(5, 8)
    assert found(spark, few) == plain(few)
    assert found(spark, [(i, [0.5] * 8, None) for i in range(60)]) == plain([(i, [0.5] * 8, None) for i in range(60)])
    narrow = made(40, 3)  # parts of no width
    assert found(spark, narrow) == plain(narrow)
    codes, books = vector_codes(spark.createDataFrame([], SCHEMA))
    assert codes.collect() == [] and books == [] and codes.columns == ["id", "label", "code", "error", "label_error"]
    nothing = [(1, [], 3), (2, [], 3)]
    assert found(spark, nothing) == ([(1, 3, "00" * 8, 0, 0), (2, 3, "00" * 8, 0, 0)], hashlib.sha256(b"," * 0).hexdigest())


def test_the_most_frequent_width_stays(spark):
    rows = made(30, 8) + [(100 + i, [1.0] * 4, 1) for i in range(9)] + [(-1, [], 1)]
    assert found(spark, rows) == plain(made(30, 8))


def test_numbers_of_any_size(spark):
    rows = [(i, [x * 1e12 for x in v], y) for i, v, y in made(60, 8)]
    got, digest = found(spark, rows)
    want, same = plain(rows)
    fits = lambda x: x if x < 1 << 63 else None
    assert digest == same and got == sorted(((i, y, c, fits(e), None if any(fits(w[3]) is None for w in want if w[1] == y) else fits(t))
                                             for i, y, c, e, t in want), key=str)
    assert whole_numbers(np.array([[1e300, -0.3]]), True).tolist() == [[int(1e300) * 4096, -1229]]


def test_hot_label_and_clashing_names(spark):
    rows = [(7, v, 1) for _, v, _ in made(500, 8)] + made(20, 8, 4)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "v", "code", "error", "salt", "p", "a.b"):
        df = df.withColumn(name, F.lit("x"))
    codes, books = vector_codes(df)
    assert (sorted((tuple(r) for r in codes.collect()), key=str), books_sha256(books)) == plain(rows)


def test_decoded_is_near(spark):
    rows = made(400, 16)
    codes, books = vector_codes(spark.createDataFrame(rows, SCHEMA))
    vector = {i: v for i, v, _ in rows}
    for r in decoded(codes, books).collect():
        off = sum((a - b) ** 2 for a, b in zip(r["vector"], vector[r["id"]], strict=True))
        assert abs(math.sqrt(off) - math.sqrt(r["error"]) / 4096) < 4 / 4096


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, digest = plain(rows)
    got = sorted((tuple(r) for r in Q.op11_vector_codes(spark, sf).collect()), key=str)
    assert got == sorted(((i, c, e, t, digest) for i, _, c, e, t in want), key=str)
