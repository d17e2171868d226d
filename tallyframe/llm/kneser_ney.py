"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

The model is over bytes, order ``ORDER``, so it needs no tokeniser and knows every language of its training
text.  It is trained on one half of the documents that are labelled good and not toxic; the perplexities of the
other half give the thresholds.

Counts are sharded by n-gram.  Every chunk of documents (:mod:`.chunks`) sends its distinct n-grams with their
counts in trusted text; summed, these are the n-grams of the whole corpus with their training counts (zero for
those never seen there).  Lower orders count continuations: the distinct bytes on the left.  From the lowest
order up, joins on context and suffix give each n-gram its probability,

    p(b | ctx) = (c - D(c)) / c(ctx) + (D1 n1(ctx) + D2 n2(ctx) + D3 n3(ctx)) / c(ctx) * p(b | shorter ctx),

and the result goes back to the chunks that asked.  A document's score is the mean number of bits a byte,
log2 of its perplexity.  A document is rejected above the threshold of its language and length class:
the 0.995 quantile of the trusted documents held out.  The rank is the conformal one, so a class needs 199 of
them; from 20 on a class takes its maximum, below that the larger of this and the quantile of its language, or of
all languages, in either case with ``SLACK`` on top.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallyframe.llm.chunks import CHUNK_BYTES, chunk_count, chunk_of, fragments, opened, tag_chunk, tag_count, tagged
from tallyframe.llm.rows import beside, checkpointed, col, packed, text_of, unpacked

ORDER = 5
QUANTILE = 0.995
#: One in so many trusted documents is held out for the thresholds.
HOLD = 2
#: Held-out documents from which a class stands on its own, and what is added without a quantile of its own (bits a byte).
ENOUGH, SLACK = 20, 0.1
#: Bytes whose n-grams are unpacked at a time.
SLICE = 1 << 21


def grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(codes, n): the n-grams that end at each byte of each text and at its end, ``n`` for each text.

    A text is preceded by ``order - 1`` zero bytes and ended by one; a code is its n-gram's bytes, the last one lowest.
    """
    pad = bytes(order - 1)
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t, b"\0")), np.uint8)
    n = np.array([len(t) + 1 for t in texts], np.int64)
    start = np.cumsum(n + order - 1) - n  # of the positions that count
    inside = np.ones(len(data), bool)
    for back in range(1, order):
        inside[start - back] = False
    at = np.flatnonzero(inside)
    codes = np.zeros(len(at), np.int64)
    for back in range(order - 1, -1, -1):
        codes = (codes << 8) | data[at - back]
    return codes, n


def _slices(table: pa.Table):
    """(first row, texts) of parts of a fragment of about SLICE bytes."""
    texts, size, first = [], 0, 0
    column = table.column("t")
    for i in range(len(column)):
        texts.append(column[i].as_py())
        size += len(texts[-1])
        if size >= SLICE:
            yield first, texts
            texts, size, first = [], 0, i + 1
    if texts:
        yield first, texts


def _summed(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    u, inverse = np.unique(np.concatenate(codes), return_inverse=True)
    return u, np.bincount(inverse, np.concatenate(counts), len(u)).astype(np.int64)


def _count(order: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, trusted: pa.Table) -> pa.Table:
        """Distinct n-grams of a chunk with their counts in its trusted training documents."""
        known = {str(x) for x in trusted.column("id").to_pylist()}
        codes, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for table in opened(docs.column("payload")):
            ids = table.column("id").to_pylist()
            for first, texts in _slices(table):
                c, n = grams(texts, order)
                train = np.repeat([str(i) in known for i in ids[first : first + len(texts)]], n)
                u = np.unique(c)
                codes.append(u)
                counts.append(np.zeros(len(u), np.int64))
                u, k = np.unique(c[train], return_counts=True)
                codes.append(u)
                counts.append(k)
            if len(codes) > 64:
                codes, counts = ([x] for x in _summed(codes, counts))
        u, k = _summed(codes, counts)
        return pa.table({"gram": pa.array(u), "tag": pa.array(tagged(key[0].as_py(), k))})

    return run


def _score(order: int, kind: pa.DataType):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        """Bits of each document of a chunk."""
        gram = answers.column("gram").to_numpy()
        by = np.argsort(gram)
        gram, bits = gram[by], answers.column("bits").to_numpy()[by]
        out = []
        for table in opened(docs.column("payload")):
            total = np.zeros(table.num_rows)
            for first, texts in _slices(table):
                c, n = grams(texts, order)
                at = np.searchsorted(gram, c)
                if len(c) and not (gram[np.minimum(at, len(gram) - 1)] == c).all():
                    raise RuntimeError("a chunk has n-grams that it didn't ask for")
                total[first : first + len(texts)] = np.add.reduceat(bits[at], np.cumsum(n) - n)
            size = pa.compute.binary_length(table.column("t")).cast(pa.int64())
            out.append(pa.table({"id": table.column("id").cast(kind), "th": table.column("th"), "lang": table.column("lang"),
                                 "size": size, "bits": pa.array(total / (size.to_numpy() + 1))}))
        return pa.concat_tables(out)

    return run


def _discounts(level: DataFrame) -> DataFrame:
    """One row: D1, D2, D3 of Chen and Goodman from the counts of counts; where these are too few, kept within (0, k)."""
    n = [F.greatest(F.count_if(F.col("c") == k), F.lit(1)).cast("double").alias(f"k{k}") for k in (1, 2, 3, 4)]
    y = F.col("k1") / (F.col("k1") + 2 * F.col("k2"))
    d = [F.least(F.greatest(k - (k + 1) * y * F.col(f"k{k + 1}") / F.col(f"k{k}"), F.lit(0.05 * k)), F.lit(0.95 * k)) for k in (1, 2, 3)]
    return level.agg(*n).select(*[x.alias(f"d{k}") for k, x in enumerate(d, 1)])


def probabilities(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, c) of the highest order, zero counts included -> (gram, p): the interpolated probability of its last byte."""
    levels = {order: counts.select("gram", "c")}
    for k in range(order - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1))
        levels[k] = levels[k + 1].groupBy(suffix.alias("gram")).agg(F.count_if(F.col("c") > 0).alias("c"))
    lower: DataFrame | None = None
    for k in range(1, order + 1):
        level = levels[k].withColumn("ctx", F.shiftright("gram", 8))
        seen = level.filter("c > 0").groupBy("ctx").agg(
            F.sum("c").cast("double").alias("all"), *[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2)],
            F.count_if(F.col("c") >= 3).alias("n3"))
        full = beside(level, _discounts(levels[k]), "gram").join(seen, "ctx", "left")
        if lower is None:
            full = full.withColumn("low", F.lit(1 / 256))
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1))
            full = full.withColumn("suffix", suffix).join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("low")), "suffix")
        less = F.when(F.col("c") == 0, 0.0).when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        rest = F.col("d1") * F.col("n1") + F.col("d2") * F.col("n2") + F.col("d3") * F.col("n3")
        p = (F.col("c") - less) / F.col("all") + rest / F.col("all") * F.col("low")
        lower = full.select("gram", F.coalesce(p, F.col("low")).alias("p"))
    return lower


def _held(id_: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(9), id_.cast("string")), F.lit(HOLD)) == 0


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """Distinct ids of the documents labelled good and not toxic."""
    good = (col(quality_col) == 1) & (F.coalesce(col(toxic_col), F.lit(0)) == 0)
    return labels.filter(good & col(id_col).isNotNull()).select(col(id_col).alias("id")).distinct()


def perplexities(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 order: int = ORDER, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: id, th, lang, size (bytes), bits (a byte, the end counted as one)."""
    chunks = chunk_count(docs, text_col, chunk_bytes)
    lang = F.coalesce(col(lang_col).cast("string"), F.lit(""))
    texts = fragments(docs, chunks, id_col, text_col, lang=lang)
    train = trusted.filter(~_held(F.col("id"))).select(chunk_of(F.col("id"), chunks).alias("chunk"), F.col("id").cast("string").alias("id"))
    asked = texts.groupBy("chunk").cogroup(train.groupBy("chunk")).applyInArrow(
        _count(order), "gram long not null, tag long not null").repartition("gram")
    table = probabilities(asked.groupBy("gram").agg(F.sum(tag_count(F.col("tag"))).alias("c")), order)
    answers = asked.join(table, "gram").select(tag_chunk(F.col("tag")).alias("chunk"), "gram", (-F.log2("p")).cast("float").alias("bits"))
    field = docs.select(col(id_col).alias("id")).schema[0]
    kind = to_arrow_type(field.dataType)
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(order, kind), f"id {field.dataType.simpleString()}, th long, lang string, size long, bits double")


def thresholds(held: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Scores of trusted documents held out (lang, size_class, bits) -> (lang, size_class, own, most, held, of_lang, of_all).

    ``own`` is null in a class with too few documents for its rank, ``most`` is the largest score and ``held`` their number.  Scores are counted at a thousandth of a bit first,
    so no group has more rows than distinct scores.
    """
    counted = held.groupBy("lang", "size_class", F.ceil(F.col("bits") * 1000).alias("milli")).agg(F.count(F.lit(1)).alias("n"))

    def ranked(name: str, *keys: str) -> DataFrame:
        per = counted.groupBy(*keys, "milli").agg(F.sum("n").alias("n"))
        w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.xxhash64("n").bitwiseAND(F.lit(0).cast("long")))
        running = per.withColumn("upto", F.sum("n").over(w.orderBy("milli"))).withColumn("all", F.sum("n").over(w))
        rank = F.ceil((F.col("all") + 1) * F.lit(quantile))
        return running.groupBy(*keys).agg(
            (F.min(F.when(F.col("upto") >= rank, F.col("milli"))) / 1000).alias(name), (F.max("milli") / 1000).alias("most"),
            F.max("all").alias("held"))

    own = ranked("own", "lang", "size_class")
    of_lang = ranked("of_lang", "lang").drop("most", "held")
    return beside(own.join(of_lang, "lang"), ranked("of_all").drop("most", "held"), "lang")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   order: int = ORDER, quantile: float = QUANTILE, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: id, th, lang, size, bits, perplexity, threshold (of perplexity), kept.

    Null counts as the empty text.  A document without a byte has nothing to judge and is rejected.  A null language is a
    language of its own.  Without any trusted document held out there is no threshold, and every other document is kept.
    Rows that repeat an id are scored each on its own.  An empty table gives an empty result.
    """
    trusted = checkpointed(trusted_ids(labels))
    scored = checkpointed(perplexities(docs, trusted, id_col, text_col, lang_col, order, chunk_bytes))
    scored = scored.withColumn("size_class", F.floor(F.log2(F.col("size") + 1)).cast("int"))
    held = scored.filter(_held(F.col("id")) & (F.col("size") > 0)).join(trusted, "id", "left_semi")
    limit = checkpointed(thresholds(held.select("lang", "size_class", "bits"), quantile))
    by_class = limit.select("lang", "size_class", "own", "most", "held")
    by_lang = limit.groupBy("lang").agg(F.first("of_lang").alias("of_lang"))
    everywhere = limit.agg(F.first("of_all").alias("of_all"), F.max("most").alias("top"))
    known = beside(scored.join(by_class, ["lang", "size_class"], "left").join(by_lang, "lang", "left"), everywhere, "lang")
    pooled = F.coalesce("of_lang", "of_all", "top")
    largest = F.when(F.col("held") >= ENOUGH, F.col("most")).otherwise(F.greatest(pooled, "most"))
    bound = F.coalesce("own", largest + SLACK)
    kept = (F.col("size") > 0) & F.coalesce(F.col("bits") <= bound, F.lit(True))
    return known.select("id", "th", "lang", "size", "bits", F.pow(F.lit(2.0), "bits").alias("perplexity"),
                        F.pow(F.lit(2.0), bound).alias("threshold"), kept.alias("kept"))


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   **options) -> DataFrame:
    """The documents that the classifier keeps, with the columns they came with."""
    scores = quality_scores(docs, labels, id_col, text_col, lang_col, **options)
    kept = scores.filter("kept").select(_key(F.col("id"), F.col("th"), F.col("lang")).alias("key")).distinct()
    lang = F.coalesce(col(lang_col).cast("string"), F.lit(""))
    rows = docs.select(_key(col(id_col), F.xxhash64(text_of(text_col)), lang).alias("key"), packed(docs).alias("row"))
    return unpacked(rows.join(kept, "key", "left_semi"), "row", docs.columns)


def _key(*parts: Column) -> Column:
    shown = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]
    return reduce(lambda a, b: F.concat(a, F.lit("|"), b), shown)
