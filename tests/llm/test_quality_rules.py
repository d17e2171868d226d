import re

import numpy as np
from cases import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm.quality_rules import BASE, RULES, figures, fit, posterior, quality_verdicts, repeated_words


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "A", " ", "\n", "#", "é", "\x1c", "\x85", " ", "\t", "<", "😀", "a b a b", "\nb\n"]), max_size=40).map("".join))
def test_base_figures_against_a_plain_version(text):
    assert figures(text)[: len(BASE)] == plain(text)
    assert repeated_words([]) == 0


def test_em_finds_the_accuracies_of_simulated_rules():
    r = np.random.default_rng(5)
    truth = r.random(20_000) < 0.7
    accuracy = np.array([0.95, 0.9, 0.8, 0.7, 0.85])
    votes = np.where(r.random((20_000, 5)) < accuracy, 1, -1) * np.where(truth, 1, -1)[:, None] * (r.random((20_000, 5)) < 0.8)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    good, found = fit(patterns, counts)
    assert abs(good - 0.7) < 0.03 and np.abs(found - accuracy).max() < 0.03
    assert ((posterior(votes, good, found) >= 0.5) == truth).mean() > 0.9


def test_verdicts_agree_with_the_labels(spark):
    folder = "/root/testdata/sf0.1"
    out = quality_verdicts(spark.read.parquet(f"{folder}/documents.parquet"))
    x = out.join(spark.read.parquet(f"{folder}/labels.parquet").withColumnRenamed("doc_id", "id"), "id").filter("not base_failed")
    n = {(r["quality"], r["kept"]): r["count"] for r in x.groupBy("quality", "kept").count().collect()}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.99
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) > 0.9


def test_odd_rows(spark):
    docs = documents(spark, clashing=True)
    out = quality_verdicts(docs).collect()
    want = sorted(((r["doc_id"], *plain(r["text"] or "")) for r in docs.collect() if len(r["text"] or "") < 1000), key=str)
    got = sorted(((r["id"], *[r[c] for c in BASE]) for r in out if r["word_chars"] < 1000), key=str)
    assert got == want and all(r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"]) for r in out)
    assert not any(r["kept"] and r["base_failed"] for r in out) and len(RULES) == 10
    assert quality_verdicts(documents(spark, [])).count() == 0
