import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import documents, files

from tallyframe.llm.kneser_ney import grams, perplexities, probabilities, quality_filter, quality_scores, thresholds


class Plain:
    """Interpolated modified Kneser-Ney over bytes, in dictionaries; the n-grams asked for don't matter."""

    def __init__(self, texts, order):
        self.order, self.c = order, {order: Counter()}
        for t in texts:
            data = bytes(order - 1) + t + b"\0"
            self.c[order].update(data[i : i + order] for i in range(len(data) - order + 1))
        for k in range(order - 1, 0, -1):
            self.c[k] = Counter(g[1:] for g in self.c[k + 1])
        self.d, self.ctx = {}, {}
        for k, counts in self.c.items():
            n = [max(1, sum(v == i for v in counts.values())) for i in (1, 2, 3, 4)]
            y = n[0] / (n[0] + 2 * n[1])
            self.d[k] = [0, *[min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05 * i), 0.95 * i) for i in (1, 2, 3)]]
            ctx = defaultdict(lambda: [0, 0, 0, 0])
            for g, v in counts.items():
                ctx[g[:-1]][0] += v
                ctx[g[:-1]][min(v, 3)] += 1
            self.ctx[k] = ctx

    def p(self, g):
        if not g:
            return 1 / 256
        k, d, low = len(g), self.d[len(g)], self.p(g[1:])
        if g[:-1] not in self.ctx[k]:
            return low
        total, *n = self.ctx[k][g[:-1]]
        v = self.c[k][g]
        return (v - d[min(v, 3)]) / total + sum(a * b for a, b in zip(d[1:], n, strict=True)) / total * low

    def bits(self, t):
        data = bytes(self.order - 1) + t + b"\0"
        return -sum(math.log2(self.p(data[i : i + self.order])) for i in range(len(t) + 1)) / (len(t) + 1)


def test_plain_model_sums_to_one():
    m = Plain([b"abracadabra", b"banana"], 3)
    for ctx in (b"ab", b"an", b"zz", b"\0\0"):
        assert sum(m.p(ctx + bytes([b])) for b in range(256)) == pytest.approx(1)


def test_grams():
    codes, n = grams([b"ab", b""], 3)
    assert n.tolist() == [3, 1] and [c.to_bytes(3, "big") for c in codes.tolist()] == [b"\0\0a", b"\0ab", b"ab\0", b"\0\0\0"]


@pytest.mark.parametrize("order", [2, 4])
def test_perplexities_against_the_plain_model(spark, order):
    r = random.Random(2)
    text = lambda: " ".join(r.choice(["the", "cat", "sat", "é", "on", "mats"]) for _ in range(r.randint(0, 20)))
    rows = [(i, text() if i % 9 else None, "en", "s", 0) for i in range(60)] + [(70, "zzz qqq", None, None, 0), (None, "the cat", "en", "s", 0)]
    trusted = spark.createDataFrame([(i,) for i in range(30)], "id long")
    from tallyframe.llm.kneser_ney import _held
    from pyspark.sql import functions as F
    train = {x["id"] for x in trusted.filter(~_held(F.col("id"))).collect()}
    assert 5 < len(train) < 25
    m = Plain([(t or "").encode() for i, t, *_ in rows if i in train], order)
    out = perplexities(documents(spark, rows, clashing=True), trusted, order=order, chunk_bytes=700).collect()
    want = {i: m.bits((t or "").encode()) for i, t, *_ in rows}
    assert len(out) == len(rows)
    for x in out:
        assert x["bits"] == pytest.approx(want[x["id"]], rel=1e-5)


def test_probabilities_of_every_continuation_sum_to_one(spark):
    m = [int.from_bytes(bytes([a, b]), "big") for a in (97, 98) for b in range(256)]
    counts = spark.createDataFrame([(g, (g * 7) % 5 if g % 3 else 0) for g in m], "gram long, c long")
    p = defaultdict(float)
    for r in probabilities(counts, 2).collect():
        p[r["gram"] >> 8] += r["p"]
    assert p[97] == pytest.approx(1) and p[98] == pytest.approx(1)


def test_thresholds_are_conformal_quantiles(spark):
    r = np.random.default_rng(0)
    a, b = np.round(r.random(400), 3), np.round(r.random(50), 3)
    rows = [("en", 5, float(x)) for x in a] + [("de", 5, float(x)) for x in b]
    out = {x["lang"]: x for x in thresholds(spark.createDataFrame(rows, "lang string, size_class int, bits double")).collect()}
    assert out["en"]["own"] == pytest.approx(np.sort(a)[math.ceil(401 * 0.995) - 1], abs=1e-3)
    assert out["de"]["own"] is None and out["de"]["held"] == 50 and out["de"]["most"] == pytest.approx(b.max(), abs=1e-3)


def test_odd_rows_filter_and_no_labels(spark, tmp_path):
    docs = documents(spark, clashing=True)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality_filter(docs, none)
    assert out.columns == docs.columns and out.count() == sum(bool(r["text"]) for r in docs.collect())
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 14)] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    scores = quality_scores(docs, labels)
    assert scores.count() == docs.count() and not scores.filter("size = 0 and kept").count()
    assert quality_scores(documents(spark, []), labels).count() == 0


def test_junk_goes_and_trusted_prose_stays(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    x = quality_scores(docs, labels).join(labels.withColumnRenamed("doc_id", "id"), "id").filter("toxic = 0")
    n = {(r["quality"], r["kept"]): r["count"] for r in x.groupBy("quality", "kept").count().collect()}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.97 and n[0, False] / (n[0, False] + n.get((0, True), 0)) > 0.6
