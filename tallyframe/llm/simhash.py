"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at three or fewer differing bits, so one of the
two 32-bit halves differs in one bit at most.  For each half the anchors are the
points of a covering code: the perfect Hamming code of length 31 (covering
radius 1) and one free bit.  If x and y differ in at most one bit of the half,
the anchor nearest to x lies within covering radius + threshold = 2 of y.  So
every distinct fingerprint goes home to its nearest anchor and is replicated to
every anchor within 2 (17 at most a half), and linked pairs meet at an anchor, where
all 64 bits are compared.  Copies share one fingerprint and are replicated once.

What leaves an anchor are not the pairs but, for each component found there, one edge
a member to its least member, so a dense group gives as many edges as members.
Components of the edges are found by contraction (:mod:`.components`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.components import components
from tallyframe.llm.rows import checkpointed, col, packed, text_of, unpacked

#: Fixed by the contract: words in a shingle, seed of the hash, most differing bits.
SHINGLE = 3
SEED = 42
MAX_BITS = 3
#: Shingles that are unpacked to bits at a time.
CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> bytes:
    """Eight bytes, most significant first: a bit is 1 if over half of the shingles' hashes have it.

    Words are split at ASCII white space after A-Z are lower-cased; a text of fewer words than a shingle is one
    shingle, a text without words has fingerprint zero.
    """
    words = text.lower().split()  # on bytes both know ASCII only
    n = max(len(words) - shingle + 1, 1)
    if not words:
        return bytes(8)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        some = words[start : start + CHUNK + shingle - 1]
        runs = zip(*(some[i:] for i in range(min(shingle, len(words)))), strict=False)
        digests = b"".join([xxhash.xxh64_digest(b" ".join(run), seed) for run in runs])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(ones * 2 > n).tobytes()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(id, th, fp): the document's id, a hash of its text and its fingerprint as a signed long."""
    kind = docs.select(col(id_col)).schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("t")
            found = b"".join(fingerprint(texts[i].as_py(), shingle, seed) for i in range(len(texts)))
            fp = np.frombuffer(found, ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("th"), pa.array(fp)], ["id", "th", "fp"])

    text = text_of(text_col)
    rows = docs.select(col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.cast("binary").alias("t"))
    return rows.mapInArrow(run, f"id {kind.simpleString()}, th long, fp long")


# --- anchors -----------------------------------------------------------------------------------------

_PARITY = [np.uint64(sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1)) for j in range(5)]


def _syndrome(word: np.ndarray) -> np.ndarray:
    """Position 1..31 of the bit that leads to the nearest code word; 0 for a code word itself."""
    out = np.zeros(len(word), np.uint64)
    for j, mask in enumerate(_PARITY):
        out |= (np.bitwise_count(word & mask) & np.uint8(1)).astype(np.uint64) << np.uint64(j)
    return out


def _bit(position: np.ndarray) -> np.ndarray:
    """The bit at ``position`` 1..31; none at 0."""
    return (np.uint64(1) << position) >> np.uint64(1)


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) for uint64 fingerprints: the anchors within 2 of either half, the nearest one marked."""
    rows, points, home = [], [], []
    at = np.arange(len(fp))
    free = np.uint64(1 << 31)

    def add(which, point, nearest, half):
        rows.append(at[which])
        points.append(point[which] | np.uint64(half << 32))
        home.append(np.full(int(which.sum()), nearest))

    for half in (0, 1):
        word = fp >> np.uint64(32) if half else fp & np.uint64(0xFFFFFFFF)
        s = _syndrome(word)
        near = word ^ _bit(s)
        every = np.ones(len(fp), bool)
        add(every, near, True, half)
        add(every, near ^ free, False, half)  # at distance 1, or 2 where the nearest code word is at 1
        for p in range(1, 32):
            p64 = np.uint64(p)
            q = s ^ p64
            add((s > 0) & (q > p64), word ^ _bit(np.full(len(fp), p64)) ^ _bit(q), False, half)
    return np.concatenate(rows), np.concatenate(points), np.concatenate(home)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        for start in range(0, len(fp), 1 << 14):
            some = fp[start : start + (1 << 14)]
            row, point, home = anchors(some.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(point.astype(np.int64)), pa.array(~home), pa.array(some[row])], ["anchor", "away", "fp"])


# --- comparison at the anchors -----------------------------------------------------------------------

#: Comparisons that are held in memory at a time.
PAIRS = 1 << 21


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, least member) for the components of the links (u, v), least members themselves left out."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    off = label != np.arange(len(nodes))
    return nodes[off], nodes[label[off]]


def _linked(left: np.ndarray, right: np.ndarray, max_bits: int) -> np.ndarray:
    x = left ^ right
    return (x != 0) & (np.bitwise_count(x.view(np.uint64)) <= max_bits)


def _links(anchor: np.ndarray, fp: np.ndarray, homes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the fingerprints of each anchor and those at home there; rows come by anchor, homes first."""
    start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    size = np.diff(np.r_[start, len(anchor)])
    at_home = np.add.reduceat(homes.astype(np.int64), start)
    u, v = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    small = (at_home > 0) & (size > 1) & (size * at_home <= PAIRS)
    first, n, h = start[small], size[small], at_home[small]
    cut = np.searchsorted(np.cumsum(n * h), np.arange(PAIRS, int((n * h).sum()) + PAIRS, PAIRS), side="right")
    for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(n)], strict=True):
        if hi <= lo:
            continue
        rows = np.repeat(first[lo:hi], n[lo:hi]) + _counted(n[lo:hi])
        times, base = np.repeat(h[lo:hi], n[lo:hi]), np.repeat(first[lo:hi], n[lo:hi])
        left, right = np.repeat(rows, times), np.repeat(base, times) + _counted(times)
        yes = _linked(fp[left], fp[right], max_bits)
        u.append(fp[left[yes]])
        v.append(fp[right[yes]])
    for i in np.flatnonzero((at_home > 0) & (size * at_home > PAIRS)):
        mine, own = fp[start[i] : start[i] + size[i]], fp[start[i] : start[i] + at_home[i]]
        a, b = _compare(mine, own, max_bits)
        u.append(a)
        v.append(b)
    return np.concatenate(u), np.concatenate(v)


def _counted(times: np.ndarray) -> np.ndarray:
    """0, 1, .. for each run of so many."""
    return np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)


def _compare(rows: np.ndarray, own: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a large anchor, tile by tile, each tile folded to stars at once."""
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    step = 1024
    for i in range(0, len(rows), step):
        for j in range(0, len(own), step):
            x, y = rows[i : i + step, None], own[None, j : j + step]
            r, c = np.nonzero(_linked(x, y, max_bits))
            if len(r):
                more = _stars(rows[i + r], own[j + c])
                a, b = np.concatenate([a, more[0]]), np.concatenate([b, more[1]])
        if len(a) > 1 << 16:
            a, b = _stars(a, b)
    return a, b


def _meet(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (anchor, away); an anchor that spans batches waits for its end, and of one that gets large
        only the fingerprints at home there wait."""
        held = [np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)]

        def edges(parts, homes=None):
            anchor, away, fp = parts
            if not len(anchor):
                return
            u, v = _links(anchor, fp, ~away, max_bits)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _stars(u, v)], ["a", "b"])

        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "away", "fp")]
            held = [np.concatenate([x, y.astype(x.dtype)]) for x, y in zip(held, new, strict=True)]
            last = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            yield from edges([x[:last] for x in held])
            held = [x[last:] for x in held]
            if len(held[0]) > 1 << 16:
                yield from edges(held)
                held = [x[~held[1]] for x in held]
        yield from edges(held)

    return run


def linked(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (a, b) whose components are those of all links at ``max_bits`` (at most 3)."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the anchors cover up to three differing bits")
    replicated = distinct.select("fp").mapInArrow(_replicate, "anchor long, away boolean, fp long")
    met = replicated.repartition("anchor").sortWithinPartitions("anchor", "away")
    return met.mapInArrow(_meet(max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: id, th, fp, component_id, best.

    ``component_id`` is the smallest id that can be reached over links, the document's own included; a null id counts
    only where there is no other.  ``best`` tells the row that stands for the group: (no id, id, hash of the
    text), least first.  Null counts as the empty text; all texts without words share fingerprint zero.  Rows that
    repeat an id are documents of their own.  An empty table gives an empty result.
    """
    rows = checkpointed(fingerprints(docs, id_col, text_col, shingle, seed))
    nodes = checkpointed(rows.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "th")).alias("best")))
    roots = components(linked(nodes, max_bits)).withColumnRenamed("node", "fp")
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = placed.groupBy("root").agg(F.min("best").alias("best"))
    verdict = placed.select("fp", "root").join(groups, "root").select("fp", "best")
    return rows.join(verdict, "fp").select("id", "th", "fp", F.col("best.id").alias("component_id"), "best")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group, with the columns it came with: the smallest id; of rows that repeat it and its text, one."""
    found = near_duplicates(docs, id_col, text_col, **options)
    stays = found.filter((F.col("id").eqNullSafe(F.col("component_id"))) & (F.col("th") == F.col("best.th")))
    keys = checkpointed(stays.select(_key(F.col("id"), F.col("th")).alias("key")).distinct())
    rows = docs.select(_key(col(id_col), F.xxhash64(text_of(text_col))).alias("key"), packed(docs).alias("row"))
    first = Window.partitionBy("key").orderBy("key")
    out = rows.join(keys, "key", "left_semi").withColumn("nth", F.row_number().over(first)).filter("nth = 1")
    return unpacked(out, "row", docs.columns)


def _key(id_, th):
    return F.concat_ws("|", id_.isNull().cast("string"), F.coalesce(id_.cast("string"), F.lit("")), th.cast("string"))
