"""The validated append on streams: candidates meet their parents under watermarks.

Candidates and parents are two streams with event times.  A candidate is decided once: when its parent comes within
``window`` of it, or, as rejected for want of a parent, when the watermark has passed that time.  Both sides are kept in
the state store by key for the window only.  Accepted rows, rejected rows and their counts leave one foreachBatch sink;
its batches are appended as ``operators.append.append_batch`` does, so a batch that runs again is appended once.

Rows behind the watermark can't be joined any more; Spark drops them, and :func:`dropped_late` tells how many each
stateful step of a query has dropped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.append import append_batch


def validated_stream(candidates: DataFrame, parents: DataFrame, key: str, candidate_time: str, parent_time: str, eligible: Column, *,
                     window: str = "1 day", lateness: str = "1 day", carry_cols=(), checks: dict[str, Column] | None = None) -> DataFrame:
    """``candidates`` with the carried columns of their parents and ``reject_reason`` (NULL = accepted), in append mode.

    The reasons are those of ``operators.append.validate_candidates``.  A parent counts if its time is within ``window``
    of the candidate's.  Of several parents with one key only the first to come within the lateness counts.  A NULL key
    has no parent; candidates without a time are decided at once, as without parent.
    """
    carry_cols = [carry_cols] if isinstance(carry_cols, str) else list(carry_cols)
    known = parents.withWatermark(parent_time, lateness).dropDuplicatesWithinWatermark([key]).select(
        F.col(key).alias("_key"), F.col(parent_time).alias("_at"), F.coalesce(eligible, F.lit(False)).alias("_eligible"), *carry_cols)
    asked = candidates.withWatermark(candidate_time, lateness)
    span = F.expr(f"INTERVAL {window}")
    near = (F.col("_at") >= F.col(candidate_time) - span) & (F.col("_at") <= F.col(candidate_time) + span)
    met = asked.join(known, (F.col(key) == F.col("_key")) & near, "left_outer")
    reason = F.when(F.col("_eligible").isNull(), "unknown parent").when(~F.col("_eligible"), "parent not eligible")
    for why, condition in (checks or {}).items():
        reason = reason.when(~F.coalesce(condition, F.lit(False)), why)
    return met.withColumn("reject_reason", reason).drop("_key", "_at", "_eligible")


def append_verdicts(target: str, name: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink for :func:`validated_stream`: micro-batch ``n`` is batch ``name-n`` of ``target``, accepted and
    rejected rows beside each other.  ``operators.append.appended`` and ``read_batches(..., "rejected")`` read them."""

    def sink(batch: DataFrame, number: int) -> None:
        kind = F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
        append_batch(batch.withColumn("verdict", kind), target, f"{name}-{number:012d}", "verdict")

    return sink


def dropped_late(query) -> dict[str, int]:
    """Rows behind the watermark that each stateful step of a running or stopped query dropped, as far back as the query
    keeps its progress (``spark.sql.streaming.numRecentProgressUpdates`` batches)."""
    found: Counter = Counter()
    for progress in query.recentProgress:
        for i, step in enumerate(progress["stateOperators"]):
            found[f"{i} {step['operatorName']}"] += step["numRowsDroppedByWatermark"]
    return dict(found)
