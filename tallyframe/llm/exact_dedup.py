"""Exact dedup with skew-safe combining, in DataFrame functions only.

Three combining stages, each grouping on the digest *and* the whole normalised
text, so equality never rests on a digest alone:

1. local: each input task combines the copies it reads (Spark's map-side half
   of the salted aggregation);
2. salted: the local winners of one digest are merged under ``salts`` salts of
   the document id, so a group that holds a third of all rows is spread over
   ``salts`` tasks;
3. global: at most ``salts`` winners of each text meet.

The verdict goes back to the rows on (digest, salt): every salted share of a
group joins its own copy of the verdict, and no join key is hotter than a
salted share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.rows import WHITE, col, packed, text_of, unpacked

SALTS = 64


def _digested(docs: DataFrame, id_col: str, text_col: str, salts: int, whole_rows: bool) -> DataFrame:
    norm = F.translate("t", WHITE, "")
    kept = [packed(docs).alias("row")] if whole_rows else []
    return (
        docs.select(col(id_col).alias("id"), text_of(text_col).alias("t"), *kept)
        .withColumn("norm", norm)
        .withColumn("sha", F.sha2(F.col("norm").cast("binary"), 256))
        .withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
        # least first: most code points in the original text, then a known id, then the smallest id
        .withColumn("rank", F.struct((-F.length("t")).alias("n"), F.col("id").isNull().alias("no_id"), F.col("id").alias("id")))
    )


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
             whole_rows: bool = False) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 (and ``row``, the whole document).

    Texts are equal when they are identical after all ASCII white space is
    deleted; null counts as empty, and empty texts are one group.  The longest
    original text stays (code points), then the smallest id; a null id loses to
    any other.  Of rows that repeat both the id and the length of the winner,
    one is kept.  An empty table gives an empty result.
    """
    rows = _digested(docs, id_col, text_col, salts, whole_rows)
    salted = rows.groupBy("sha", "salt", "norm").agg(F.min("rank").alias("best"), F.count(F.lit(1)).alias("n"))
    merged = salted.groupBy("sha", "norm").agg(
        F.min("best").alias("best"), F.sum("n").alias("group_size"), F.collect_set("salt").alias("salts"))
    verdict = merged.select("sha", F.explode("salts").alias("salt"), "best", "group_size")
    narrow = rows.select("id", "sha", "salt", "rank", *(["row"] if whole_rows else []))
    first = Window.partitionBy("sha", "salt", "id").orderBy("rank")
    return (
        narrow.join(verdict, ["sha", "salt"])
        .withColumn("nth", F.row_number().over(first))
        .select(
            "id",
            F.col("best.id").alias("keep_id"),
            F.col("group_size").cast("long").alias("group_size"),
            ((F.col("rank") == F.col("best")) & (F.col("nth") == 1)).alias("kept"),
            F.col("sha").alias("text_sha256"),
            *(["row"] if whole_rows else []),
        )
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The documents that stay, with the columns they came with (see :func:`verdicts`)."""
    out = verdicts(docs, id_col, text_col, salts, whole_rows=True)
    return unpacked(out.filter("kept"), "row", docs.columns)
