"""Exact distinct counts that can be merged: bitmaps of ids.

A set of whole-number ids is kept as one bitmap of 32,768 bits per range of ids.  Bitmaps of one range are merged by OR, so
counts of a coarser level come from those of a finer one, without the rows, and a large group is as many rows as its ids
span ranges, not one task.  A bitmap takes 4 KB however few bits are set: use this where ids are dense within the groups
(keys of one table by region, by type), and a plain distinct count where a group holds few ids of a wide range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def distinct_bitmaps(df: DataFrame, group_cols, id_col: str) -> DataFrame:
    """(groups, bucket, bits): the distinct ids of each group; NULL ids are in none."""
    at = F.col(id_col).cast("long")
    rows = df.where(at.isNotNull()).withColumn("bucket", F.bitmap_bucket_number(at))
    return rows.groupBy(*_cols(group_cols), "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))


def merged_bitmaps(bitmaps: DataFrame, group_cols) -> DataFrame:
    """The bitmaps of a coarser grouping."""
    return bitmaps.groupBy(*_cols(group_cols), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(bitmaps: DataFrame, group_cols, out_col: str = "n_distinct") -> DataFrame:
    """Distinct ids per group."""
    return bitmaps.groupBy(*_cols(group_cols)).agg(F.sum(F.bitmap_count("bits")).alias(out_col))
