"""Mixing sources to target weights by subset-sum budget fitting.

1. Documents are counted by (source, exact length): the only thing that the
   fitting reads, one row per distinct length.
2. Targets come from water-filling: a fixed share of all words is dealt by
   weight, a source's target stops at ``max_repeats`` times its size, and the
   excess is dealt again until no source is above.
3. Per source, whole passes over the source are taken while they fit; the rest
   of the budget is a bounded knapsack over the length counts: each length
   gives its proportional share of documents, and dynamic programming over the
   left-over counts fits the remaining words exactly, or as near as they allow.
4. Per (source, length) the wanted number of documents is taken in the order of
   a seeded hash.  The order is dealt over hash slices, so a hot (source,
   length) is numbered by many tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.rows import checkpointed, col, n_words, packed, text_of

#: Fixed by the contract: weights by a source's place, share of all words, most copies of a document.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_REPEATS = 2


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) -> (source, source_size, target); ``source`` is not null.

    Sources rank by code point and weigh ``weights`` in turn.  With
    a level L, a source gets min(max_repeats * size, L * weight); each round
    finds the sources that stop at their bound and raises L for the others,
    until no more stop.  Only totals reach the driver.
    """
    spark = sizes.sparkSession
    ordered = sizes.sort("source").rdd.zipWithIndex()
    schema = "source string, source_size long, weight double, bound double"
    k = len(weights)
    ranked = checkpointed(spark.createDataFrame(
        ordered.map(lambda x: (x[0][0], x[0][1], weights[x[1] % k], float(max_repeats * x[0][1]))), schema))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget, level, stopped = share * total, 0.0, -1
    while True:
        at_bound = F.col("bound") <= F.lit(level) * F.col("weight")
        n, full, free = ranked.agg(
            F.count_if(at_bound), F.sum(F.when(at_bound, F.col("bound"))), F.sum(F.when(~at_bound, F.col("weight")))).first()
        if n == stopped or not free:
            break
        stopped, level = n, (budget - (full or 0.0)) / free
    target = F.least("bound", F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length (ascending, positive, distinct) to take so that the words
    taken come as near to ``budget`` as bounded counts allow, from below; time and memory follow the number
    of lengths and the longest length, not the number of documents."""
    take = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return counts.copy()
    # proportional shares, rounded along the running count: the words are off by one longest document at most
    running = np.floor(np.cumsum(counts) * (budget / total)).astype(np.int64)
    take = np.minimum(np.diff(running, prepend=0), counts)
    rest = budget - int((lengths * take).sum())
    # the table below fits a window of some longest documents: give back, or take, whole documents until it covers the rest
    window = int(lengths[-1]) * 8
    for i in range(len(lengths)):  # short ones first, which fit best
        less = min(int(take[i]), 4, max(window // 2 - rest, 0) // int(lengths[i]))
        if rest >= window // 2:
            break
        take[i] -= less
        rest += less * int(lengths[i])
    for i in range(len(lengths) - 1, -1, -1):
        words = int(lengths[i])
        more = min(int(counts[i] - take[i]), max(rest - window, 0) // words)
        less = min(int(take[i]), -(min(rest - window, 0) // words))
        take[i] += more - less
        rest -= (more - less) * words
    return take + _bounded_knapsack(lengths, counts - take, rest)


def _bounded_knapsack(lengths: np.ndarray, left: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset sum: the counts (at most ``left``) whose words come nearest to ``budget`` from below.

    Counts are split into powers of two.  ``first[s]`` is the item by which sum s was reached first, so
    walking back from the best sum uses each item once.
    """
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    first = np.full(budget + 1, -1, np.int64)
    items: list[tuple[int, int]] = []
    for i in range(len(lengths)):
        free, step = min(int(left[i]), budget // int(lengths[i])), 1
        while free > 0 and not reached[budget]:
            n = min(step, free)
            w = n * int(lengths[i])
            new = reached[: budget + 1 - w] & ~reached[w:]
            at = np.flatnonzero(new) + w
            first[at] = len(items)
            reached[at] = True
            items.append((i, n))
            free, step = free - n, step * 2
        if reached[budget]:
            break
    s, out = int(np.flatnonzero(reached)[-1]), np.zeros(len(lengths), np.int64)
    while s > 0:
        i, n = items[first[s]]
        out[i] += n
        s -= n * int(lengths[i])
    return out


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("size")
    positive = pdf[pdf["size"] > 0]
    size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    budget = int(np.floor(target + 0.5))
    passes = budget // size if size else 0
    take = fit_counts(positive["size"].to_numpy(np.int64), positive["n"].to_numpy(np.int64), budget - passes * size)
    pdf["passes"], pdf["extra"] = passes, 0
    pdf.loc[positive.index, "extra"] = take
    return pdf[["source", "size", "source_size", "target", "passes", "extra"]]


def _key(source_col: str):
    """The source as a key that is never null; the null source sorts after all others."""
    source = col(source_col).cast("string")
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7,
          weights=WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS, whole_rows: bool = False) -> DataFrame:
    """One row per document: id, size, source_size, target, copies, taken (and ``row``, the whole document).

    ``size`` counts the words of the whole text (null text: 0), ``copies`` says how often the mix takes the
    document and ``taken`` is copies * size.  A null source is a source of its own, last in order.  Documents
    without words are taken as often as a full pass takes any document, which adds no words.  Rows that
    repeat an id are separate documents; identical ones are interchangeable.  An empty table gives an empty result.
    """
    rows = docs.select(
        col(id_col).alias("id"), _key(source_col).alias("source"), n_words(text_of(text_col)).alias("size"),
        *([packed(docs).alias("row")] if whole_rows else []),
    ).withColumn("h", F.xxhash64(F.lit(seed), "id")).withColumn("slice", F.shiftright("h", 58))
    per_slice = checkpointed(rows.groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("n")))
    lengths = per_slice.groupBy("source", "size").agg(F.sum("n").alias("n"))
    goal = targets(per_slice.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
                   weights, share, max_repeats)
    fitted = lengths.join(goal, "source").groupBy("source").applyInPandas(
        _fit_source, "source string, size long, source_size long, target double, passes long, extra long")
    # documents before each slice of a (source, length), in the order of the seeded hash
    before = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    wanted = offsets.join(fitted, ["source", "size"]).select(
        "source", "size", "slice", "source_size", "target", "passes", (F.col("extra") - F.col("before")).alias("extra"))
    nth = F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("h", "id"))
    out = rows.withColumn("nth", nth).join(wanted, ["source", "size", "slice"])
    copies = (F.col("passes") + (F.col("nth") <= F.col("extra")).cast("long")).cast("long")
    return out.select(
        "id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), *(["row"] if whole_rows else []))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as the mix takes it, with the columns it came with."""
    out = mixed(docs, whole_rows=True, **options).filter("copies > 0")
    return out.select(F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))), "row").select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns])
