import pytest
from fixtures import rows
from pyspark.sql import functions as F

from tallyframe.operators import append as A
from tallyframe.operators.append import appended, manifests, validated_append
from tallyframe.sources.literal import frame


def test_validated_append_writes_accepted_and_returns_rejects(spark, tmp_path):
    parents = frame(spark, "order_id int, runner_id int, pickup_time string", [
        (1, 10, "2020-01-01 18:15:34"), (2, 11, ""), (3, 12, None), (4, 13, "2020-01-04 13:53:03"),
        (4, 13, "2020-01-04 13:53:03")])  # a duplicated parent row must not duplicate a rating
    cands = frame(spark, "order_id int, rating int", [(1, 5), (2, 4), (3, 3), (4, 4), (9, 2), (1, 7)])
    target = str(tmp_path / "order_rating")
    eligible = F.coalesce(F.length("pickup_time") > 0, F.lit(False))
    checks = {"rating out of range": F.col("rating").between(1, 5)}
    cols = ["order_id", "runner_id", "rating"]
    rej = validated_append(cands, parents, "order_id", eligible, target, cols, "monday", carry_cols=["runner_id"], checks=checks)
    assert rows(appended(spark, target, cols)) == [(1, 10, 5), (4, 13, 4)]
    assert rows(rej, "order_id", "reject_reason") == [
        (1, "rating out of range"), (2, "parent not eligible"), (3, "parent not eligible"), (9, "unknown parent")]
    # a second batch appends (set-at-a-time, no overwrite)
    none = validated_append(cands.where("order_id = 1 and rating = 5"), parents, "order_id", eligible, target, cols, "tuesday",
                            carry_cols=["runner_id"], checks=checks)
    assert none.collect() == [] and none.columns == rej.columns
    assert rows(appended(spark, target, cols)) == [(1, 10, 5), (1, 10, 5), (4, 13, 4)]


def _ratings(spark):
    parents = frame(spark, "order_id int, ok boolean", [(i, i % 2 == 0) for i in range(20)])
    return frame(spark, "order_id int, rating int", [(i, i % 6) for i in range(25)]), parents, "order_id", F.col("ok")


def _files(target):
    return sorted(str(p.relative_to(target)) for p in target.rglob("*.parquet"))


def test_a_batch_killed_between_write_and_commit_is_appended_once(spark, tmp_path, monkeypatch):
    args = (*_ratings(spark), str(tmp_path), ["order_id", "rating"], "b1")
    publish = A._publish

    def killed(*a):
        raise KeyboardInterrupt

    monkeypatch.setattr(A, "_publish", killed)
    with pytest.raises(KeyboardInterrupt):
        validated_append(*args)
    assert _files(tmp_path) and manifests(spark, str(tmp_path)) == {}  # written, yet nobody sees it
    with pytest.raises(ValueError):
        appended(spark, str(tmp_path))
    monkeypatch.setattr(A, "_publish", publish)
    first = rows(validated_append(*args))
    once, files = rows(appended(spark, str(tmp_path))), _files(tmp_path)
    assert [r[0] for r in once] == list(range(0, 20, 2)) and len(first) == 15
    assert rows(validated_append(*args)) == first  # running it again appends and writes nothing
    assert rows(appended(spark, str(tmp_path))) == once and _files(tmp_path) == files


def test_of_two_runs_at_once_the_first_to_commit_counts(spark, tmp_path, monkeypatch):
    args = (*_ratings(spark), str(tmp_path), ["order_id", "rating"], "a/b c")
    publish, inside = A._publish, []

    def late(*a):
        if not inside:  # another run of the batch commits before this one does
            inside.append(1)
            validated_append(*args)
        return publish(*a)

    monkeypatch.setattr(A, "_publish", late)
    validated_append(*args)
    assert len({f.split("/")[1] for f in _files(tmp_path)}) == 2 and list(manifests(spark, str(tmp_path))) == ["a/b c"]
    assert [r[0] for r in rows(appended(spark, str(tmp_path)))] == list(range(0, 20, 2))
