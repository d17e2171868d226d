"""The pipeline's stages on a small table against plain versions of their operators."""

from cases import documents, files, odd_rows
from test_exact_dedup import brute as plain_exact
from test_simhash import plain_groups

import corpus_pipeline as P
from tallyframe.llm.kneser_ney import quality_scores
from tallyframe.llm.mixing import mixed


def rows_for_a_run():
    prose = "The cat sat on the mat and the dog ran to the house. It was a good day for all of them. "
    rows = odd_rows() + [(100 + i, prose * (1 + i % 7) + f"Number {i % 30}.", "en", f"s{i % 4}", 0) for i in range(200)]
    return rows + [(400 + i, "#### $$$$ %%%% ||||" * 20, "en", "s1", 0) for i in range(10)]


def test_stages_and_run(spark, tmp_path):
    rows = rows_for_a_run()
    docs = documents(spark, rows, clashing=True)
    folder = files(spark, tmp_path, docs, [(100 + i, 1, 0) for i in range(0, 200, 2)] + [(400, 0, 0)])
    assert [name for name, _ in P.STAGES] == ["quality classifier", "exact dedup", "simhash near-dedup", "mix to target weights", "best-fit packing"]
    seen = [docs]
    for i, (_, stage) in enumerate(P.STAGES):
        stage(spark, seen[-1], folder).write.parquet(f"{tmp_path}/out{i}")
        seen.append(spark.read.parquet(f"{tmp_path}/out{i}"))
        assert i == 4 or seen[-1].columns == docs.columns
    quality, exact, near, mix, pack = seen[1:]
    verdict = quality_scores(docs, spark.read.parquet(f"{folder}/labels.parquet")).filter("kept")
    assert quality.count() == verdict.count() and not quality.filter("doc_id >= 400").count()
    good = {x[0] for x in rows if x[0] and 100 <= x[0] < 300}
    assert len(good - {r["doc_id"] for r in quality.collect()}) <= 20  # thresholds from some fifty documents
    kept = [tuple(r)[:5] for r in quality.collect()]
    assert sorted((r["doc_id"] for r in exact.collect()), key=str) == sorted((x[0] for x in plain_exact(kept) if x[3]), key=str)
    kept = [tuple(r)[:5] for r in exact.collect()]
    groups = plain_groups(kept)
    assert sorted((r["doc_id"] for r in near.collect()), key=str) == sorted((i for i, _, c in groups if i == c), key=str)
    copies = {r["id"]: r["copies"] for r in mixed(near).collect()}
    got = {}
    for r in mix.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {k: v for k, v in copies.items() if v}
    words = sum(len((r["text"] or "").encode().split()) for r in mix.collect())
    assert pack.agg({"length": "sum"}).first()[0] == words
    assert P.run(spark, folder).count() == pack.count()


def test_empty_table(spark, tmp_path):
    folder = files(spark, tmp_path, documents(spark, []))
    assert P.run(spark, folder).count() == 0
