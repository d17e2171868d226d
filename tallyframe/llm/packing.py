"""Best-fit packing into sequences of several permitted lengths.

Documents are cut into pieces of at most the largest capacity and dealt to
shards by a hash; each shard, a bounded number of narrow rows, is packed on its
own.  Within a shard, longest piece first:

* best fit: the piece goes to the open bin with the least room that still holds it;
* opening: for each permitted capacity a bin is filled on trial with the longest
  pieces still waiting that fit, and the one whose cost per word, after downsizing,
  is least is opened;
* downsizing: at the end each bin shrinks to the smallest permitted capacity that
  holds its contents.

What a trial promises other bins may take, so the shard is also packed with each
capacity as the one to open, and of all these plans the cheapest stays: mixing
lengths is never dearer than any single one.

Nothing is dropped and no text is moved: the result says which words of which
document make up which sequence.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rows import col, n_words, text_of

#: Permitted sequence lengths, in words.
CAPACITIES = (512, 1024, 2048, 4096)
#: Cost of a sequence of c words, in words: c, what each sequence costs besides, and attention that grows with c * c.
OVERHEAD, ATTENTION = 32.0, 1.0 / 65536
#: Pieces that one task packs at a time, on average.
SHARD_PIECES = 50_000


def cost(capacity: np.ndarray | int):
    return capacity + OVERHEAD + ATTENTION * capacity * capacity


def _trial(piece: int, capacity: int, shorter: list[int], waiting: int) -> int:
    """Words in a bin of ``capacity`` that opens with ``piece`` and is filled, the longest that fits first, from the first
    ``waiting`` of ``shorter``, lengths in ascending order."""
    free, last = capacity - piece, waiting
    while free and (last := bisect_right(shorter, free, 0, last)):
        last -= 1
        free -= shorter[last]
    return capacity - free


def _plan(lengths: list[int], caps: list[int], only: int | None = None) -> tuple[list[int], list[int]]:
    """(bin of each piece, words in each bin) for lengths in descending order.  ``only``: the capacity of all bins but those
    of pieces that it can't hold."""
    ascending = lengths[::-1]
    used: list[int] = []
    owner: list[int] = []
    room: list[tuple[int, int]] = []  # (room, bin) of open bins, ascending
    for i, n in enumerate(lengths):
        at = bisect_left(room, (n, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            fitting = [c for c in caps if c >= n]
            if only is not None:
                free = max(only, fitting[0])
            else:
                fills = [(_trial(n, c, ascending, len(lengths) - i - 1), c) for c in fitting]
                free = min(fills, key=lambda f: (cost(caps[bisect_left(caps, f[0])]) / f[0], f[1]))[1]
            b = len(used)
            used.append(0)
        owner.append(b)
        used[b] += n
        if free > n:
            insort(room, (free - n, b))
    return owner, used


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each piece, capacity of each bin) for positive ``lengths`` of at most the largest capacity: the cheapest of
    the plans, the one that opens by trial first of equals."""
    caps = sorted(capacities)
    order = np.argsort(-lengths, kind="stable")
    descending, sizes = lengths[order].tolist(), np.array(caps, np.int64)
    best = None
    for only in (None, *caps):
        found, used = _plan(descending, caps, only)
        capacity = sizes[np.searchsorted(sizes, np.array(used, np.int64))]
        total = float(cost(capacity).sum())
        if best is None or total < best[0]:
            best = total, found, capacity
    owner = np.empty(len(lengths), np.int64)
    owner[order] = best[1]
    return owner, best[2]


def _pack_shard(capacities: tuple[int, ...]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "h", "id", "start"], ascending=[False, True, True, True], na_position="last").reset_index(drop=True)
        owner, capacity = pack(pdf["length"].to_numpy(np.int64), capacities)
        pdf["bin"], pdf["capacity"] = owner, capacity[owner]
        pdf = pdf.sort_values("bin", kind="stable")
        pdf["position"] = pdf.groupby("bin")["length"].cumsum() - pdf["length"]
        return pdf[["id", "start", "length", "shard", "bin", "position", "capacity"]]

    return run


def packed_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacities: tuple[int, ...] = CAPACITIES,
                  shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: id, start, length, shard, bin, position, capacity.

    A piece is ``length`` words of the document from word ``start`` on; it stands at ``position`` of bin
    ``bin`` of ``shard``, a sequence of ``capacity`` words.  A document without words (null or empty text) is one
    row with length 0 and no bin.  Rows that repeat an id are packed each on its own.  An empty table gives
    an empty result.
    """
    top = max(capacities)
    words = docs.select(col(id_col).alias("id"), n_words(text_of(text_col)).alias("words"))
    pieces = words.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("words") - 1, F.lit(0)), F.lit(top)))).select(
        "id", "start", F.least(F.col("words") - F.col("start"), F.lit(top)).cast("long").alias("length")).withColumn("h", F.xxhash64("id", "start"))
    n = words.agg(F.sum(F.greatest(F.ceil(F.col("words") / top), F.lit(1)))).first()[0] or 0
    shards = max(1, -(-n // shard_pieces))
    full = pieces.filter("length > 0").withColumn("shard", F.pmod("h", F.lit(shards)).cast("long"))
    kind = docs.select(col(id_col)).schema[0].dataType.simpleString()
    out = full.groupBy("shard").applyInPandas(
        _pack_shard(tuple(capacities)), f"id {kind}, start long, length long, shard long, bin long, position long, capacity long")
    empty = pieces.filter("length = 0").select(
        "id", "start", "length", *[F.lit(None).cast("long").alias(c) for c in ("shard", "bin", "position", "capacity")])
    return out.unionByName(empty)
