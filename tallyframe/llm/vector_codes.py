"""Vector code compression: product quantisation whose codebooks are searched the way Orchard does.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook of a few entries, fitted by
rounds of assignment and averaging over *all* vectors.  For a codebook the neighbours of each entry are listed by
distance.  A search walks the list of the best entry so far: an entry that is nearer takes over and its list is walked
from the start, entries seen before are passed by, and the walk stops at the first neighbour farther from the best entry
than twice the query is, for by the triangle inequality none behind it can win.  All arithmetic is on whole numbers, so
the walk finds exactly the nearest entry, the lower one of equals.

A task searches for a batch of vectors at once and adds up what its entries won; only these sums, as many as a codebook
has numbers, leave it.  The driver holds codebooks, never vectors but the few that start them.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rows import col, written

PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: A component x becomes floor(SCALE * x).
SCALE = 4096
#: Rows of one label are added up in so many parts.
SALTS = 64
_LONG = 1 << 63


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & finite


def cuts(width: int, parts: int) -> list[slice]:
    """Consecutive parts as equal as can be, the longer ones first."""
    ends = np.cumsum([width // parts + (i < width % parts) for i in range(parts)])
    return [slice(int(a), int(b)) for a, b in zip(np.r_[0, ends[:-1]], ends, strict=True)]


def whole_numbers(values: np.ndarray, wide: bool) -> np.ndarray:
    """floor(SCALE * x), exactly.  ``wide``: as Python integers, where squared distances may leave 64 bits."""
    if not wide:
        return np.floor(values * SCALE).astype(np.int64)
    flat = [int(v) * SCALE if abs(v) >= 2**53 else math.floor(v * SCALE) for v in values.ravel().tolist()]
    out = np.empty(len(flat), object)
    out[:] = flat
    return out.reshape(values.shape)


def neighbour_lists(book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries, squared distances): for each entry all others, nearest first."""
    apart = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    order = np.array([[j for j in np.argsort(row, kind="stable") if j != i] for i, row in enumerate(apart)], np.int64)
    order = order.reshape(len(book), max(len(book) - 1, 0))
    return order, np.take_along_axis(apart, order, axis=1)


def orchard(queries: np.ndarray, book: np.ndarray, lists: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each query; all queries walk together, each its own lists."""
    near, apart = lists
    n, others = len(queries), near.shape[1]
    best, at = np.zeros(n, np.int64), np.zeros(n, np.int64)
    dist = ((queries - book[0]) ** 2).sum(axis=1)
    seen = np.zeros((n, len(book)), bool)
    seen[:, 0] = True
    live = np.arange(n)
    while len(live := live[at[live] < others]):
        here, step = best[live], at[live]
        go = (apart[here, step] <= 4 * dist[live]).astype(bool)  # farther than twice the query: none behind can win
        live, entry = live[go], near[here[go], step[go]]
        at[live] += 1
        new = ~seen[live, entry]
        rows, entry = live[new], entry[new]
        seen[rows, entry] = True
        d = ((queries[rows] - book[entry]) ** 2).sum(axis=1)
        wins = ((d < dist[rows]) | ((d == dist[rows]) & (entry < best[rows]))).astype(bool)
        rows = rows[wins]
        best[rows], dist[rows], at[rows] = entry[wins], d[wins], 0
    return best, dist


class _Coder:
    """Codebooks with their neighbour lists, for the vectors of one width."""

    def __init__(self, books: list[np.ndarray], width: int, wide: bool):
        self.books, self.width, self.wide = books, width, wide
        self.cuts = cuts(width, len(books))
        self.lists = [neighbour_lists(b) for b in books]

    def parts(self, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each part: the vectors' numbers there, their nearest entries and the squared distances."""
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        numbers = whole_numbers(flat.reshape(len(vectors), self.width), self.wide)
        for book, cut, lists in zip(self.books, self.cuts, self.lists, strict=True):
            part = numbers[:, cut]
            yield (part, *orchard(part, book, lists))


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """A whole number of any size as (limb, amount): the amounts of a limb can be added in 64 bits over many tasks."""
    sign, value, limb = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield limb, sign * (value & 0xFFFFFFFF)
        value, limb = value >> 32, limb + 1


def _averaged(vectors: DataFrame, coder: _Coder) -> list[np.ndarray]:
    """The codebooks after one round: each entry the floor of the mean of the parts nearest to it, unused ones as before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = object if coder.wide else np.int64
        sums = [np.zeros(b.shape, kind) for b in coder.books]
        counts = [np.zeros(len(b), np.int64) for b in coder.books]
        for batch in batches:
            for p, (part, entry, _) in enumerate(coder.parts(batch.column("v"))):
                won = entry[None, :] == np.arange(len(counts[p]))[:, None]
                counts[p] += won.sum(axis=1)
                sums[p] += won.astype(kind) @ part
        rows = [(p, e, -1, limb, amount) for p, c in enumerate(counts) for e, n in enumerate(c) for limb, amount in _limbs(int(n))]
        rows += [(p, e, j, limb, amount) for p, s in enumerate(sums) for (e, j), v in np.ndenumerate(s) for limb, amount in _limbs(int(v))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["p", "e", "j", "limb", "amount"])

    partial = vectors.select("v").mapInArrow(run, "p long, e long, j long, limb long, amount long")
    total: dict[tuple, int] = defaultdict(int)
    for r in partial.groupBy("p", "e", "j", "limb").agg(F.sum("amount").alias("amount")).collect():  # at most a codebook's numbers
        total[r["p"], r["e"], r["j"]] += r["amount"] << (32 * r["limb"])
    books = [b.copy() for b in coder.books]
    for p, book in enumerate(books):
        for e in range(len(book)):
            if total[p, e, -1]:
                book[e] = [total[p, e, j] // total[p, e, -1] for j in range(book.shape[1])]
    return books


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
                 entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(codes, codebooks): one row per vector with id, label, code, error, label_error, and one array of entries per part.

    ``code`` has two hexadecimal digits per part, ``error`` is the squared distance of the whole vector to its entries,
    ``label_error`` its sum over all rows of an equal label (null labels are one).  Both are null where a long can't hold
    them.  Vectors that are null or hold null or non-finite components are dropped.  All vectors should have one width;
    if not, those of the most frequent width stay (the larger of equals).  A width that ``parts`` doesn't divide gives
    longer parts first.  The codebooks start from the smallest ids; a repeated id starts one entry, from its smallest
    vector, and a null id comes last.  Repeated rows each count.  An empty table gives no rows and no codebooks.
    """
    if not 0 < entries <= 256:
        raise ValueError("codes have two hexadecimal digits for each part: 1 to 256 entries")
    v = col(vector_col).cast("array<double>")
    rows = vectors.where(usable(v)).select(col(id_col).alias("id"), col(label_col).alias("label"), v.alias("v"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error long"
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    widths = rows.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n"), F.max(largest).alias("largest"))
    shape = widths.orderBy(F.desc("n"), F.desc("width")).first()
    if shape is None:
        return vectors.sparkSession.createDataFrame([], schema + ", label_error long"), []
    width = shape["width"]
    bound = 2 * (int(shape["largest"] or 0) + 1) * SCALE
    wide = 4 * (width // parts + 1) * bound * bound >= _LONG  # distances in 64 bits, or exact at any size
    rows = rows.where(F.size("v") == width)

    first = rows.select("id").distinct().orderBy(F.col("id").asc_nulls_last()).limit(entries)
    ids = [r["id"] for r in first.collect()]
    of_first = F.col("id").isin([i for i in ids if i is not None])
    if None in ids:
        of_first = F.coalesce(of_first, F.lit(False)) | F.col("id").isNull()
    seeds = {r["id"]: r["v"] for r in rows.where(of_first).groupBy("id").agg(F.min("v").alias("v")).collect()}
    start = whole_numbers(np.array([seeds[i] for i in ids], np.float64).reshape(len(ids), width), wide)
    books = [start[:, cut] for cut in cuts(width, parts)]
    for _ in range(rounds):
        books = _averaged(rows, _Coder(books, width, wide))
    coder = _Coder(books, width, wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            codes, errors = [], 0
            for _, entry, dist in coder.parts(batch.column("v")):
                codes.append(entry)
                errors = errors + dist
            digits = np.stack(codes, axis=1).astype(np.uint8).tobytes().hex()
            texts = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
            errors = [e if e < _LONG else None for e in errors.tolist()]
            salt = (np.arange(len(texts)) + turn) % SALTS
            turn += len(texts)
            columns = [batch.column("id"), batch.column("label"), pa.array(texts, pa.string()), pa.array(errors, pa.int64()), pa.array(salt, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "code", "error", "salt"])

    coded = written(rows.mapInArrow(run, schema + ", salt int"))
    return _with_label_errors(coded), books


def _with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with the sum of its errors by label.  Both ways go over (label, salt), so that no label is one task."""
    salted = coded.groupBy("label", "salt").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("part"), F.every(F.col("error").isNotNull()).alias("fits"))
    totals = salted.groupBy("label").agg(F.when(F.every("fits"), F.sum("part")).alias("total"))
    a, b = salted.select("label", "salt").alias("a"), totals.alias("b")
    back = a.join(b, F.col("a.label").eqNullSafe(F.col("b.label"))).select("a.label", "a.salt", F.expr("try_cast(b.total AS bigint)").alias("label_error"))
    c, d = coded.alias("c"), back.alias("d")
    met = c.join(d, F.col("c.label").eqNullSafe(F.col("d.label")) & (F.col("c.salt") == F.col("d.salt")))
    return met.select("c.id", "c.label", "c.code", "c.error", "d.label_error")


def books_sha256(books: list[np.ndarray]) -> str:
    """Digest of all entries' components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def decoded(codes: DataFrame, books: list[np.ndarray], code_col: str = "code") -> DataFrame:
    """``codes`` with ``vector`` (array of double), what each code stands for: the centres of its entries' cells."""
    centres = [F.array(*[F.array(*[F.lit((int(x) + 0.5) / SCALE) for x in entry]) for entry in b]) for b in books]
    digit = lambda p: F.conv(F.substring(col(code_col), 2 * p + 1, 2), 16, 10).cast("int")
    return codes.withColumn("vector", F.concat(*[F.element_at(c, digit(p) + 1) for p, c in enumerate(centres)]))
