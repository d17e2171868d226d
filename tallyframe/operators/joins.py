"""Joins: list membership, full outer merge, unmatched flags, group totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.text import id_list


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def explode_membership(df: DataFrame, list_col, member_col: str = "member") -> DataFrame:
    """One row per (row, distinct member) of a comma separated id list.

    This is the equi-join form of "JOIN dim ON FIND_IN_SET(dim.id, list)": join
    the result to the dimension on ``member_col`` (kept as a string so an empty
    or dirty id never fails a cast).  A theta join on ``find_in_set`` would be
    planned as a nested-loop join; this is a Generate plus a hash join.
    """
    return df.withColumn(member_col, F.explode(id_list(list_col)))


def explode_array(df: DataFrame, array_col: Column, member_col: str = "member",
                  distinct: bool = True) -> DataFrame:
    """One row per (row, element) of an array expression (distinct by default)."""
    arr = F.array_distinct(array_col) if distinct else array_col
    return df.withColumn(member_col, F.explode(arr))


def member_join(df: DataFrame, list_col, dim: DataFrame, dim_key: str,
                member_col: str = "member") -> DataFrame:
    """``df`` joined to ``dim`` on list membership (see ``explode_membership``)."""
    exploded = explode_membership(df, list_col, member_col)
    keyed = dim.withColumn("_member_key", F.col(dim_key).cast("string"))
    return exploded.join(keyed, exploded[member_col] == keyed["_member_key"]).drop("_member_key")


def full_outer_merge(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Full outer join on equal keys with the keys coalesced (LEFT ∪ RIGHT)."""
    return left.join(right, on=_cols(keys), how="full_outer")


def salted_full_outer_merge(left: DataFrame, right: DataFrame, keys, hot_share: float = 0.001, salts: int = 8) -> DataFrame:
    """``full_outer_merge`` where a key may hold a large share of both sides.

    Adaptive execution doesn't split the partitions of a full outer join, so
    the rows are told apart first.  Keys that hold more than ``hot_share`` of
    either side, at most 2 / ``hot_share`` of them (a broadcast of that bound),
    are joined on a grid: left rows get one of ``salts`` rows of it and right
    rows one of ``salts`` columns, and each meets every cell of its own, so a
    key is ``salts`` x ``salts`` tasks.  Whether a hot key has rows on the
    other side is known from its counts.  All other keys take the plain join.
    Rows with a NULL in the key match nothing and are not dealt at all.
    """
    keys = _cols(keys)
    others = [c for c in left.columns if c not in keys], [c for c in right.columns if c not in keys]
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()

    def counted(side: DataFrame, nth: int) -> DataFrame:
        return side.where(known).select(*keys, *[F.lit(int(i == nth)).alias(f"_n{i}") for i in (0, 1)])

    both = counted(left, 0).unionByName(counted(right, 1))
    sums = [F.sum(f"_n{i}").alias(f"_n{i}") for i in (0, 1)]
    # totals of 0 are NULL divisors: nothing is hot on an empty side
    over = [F.coalesce(F.col(f"_n{i}") > F.lit(hot_share) * both.agg(F.sum(f"_n{i}")).scalar(), F.lit(False)) for i in (0, 1)]
    hot = F.broadcast(both.groupBy(*keys).agg(*sums).where(over[0] | over[1]))

    def told_apart(side: DataFrame) -> tuple[DataFrame, DataFrame]:
        marked = side.where(known).join(hot, keys, "left")
        return marked.where(F.col("_n0").isNull()).drop("_n0", "_n1"), marked.where(F.col("_n0").isNotNull())

    (cold_left, hot_left), (cold_right, hot_right) = told_apart(left), told_apart(right)
    grid = F.sequence(F.lit(0), F.lit(salts - 1))

    def dealt(side: DataFrame, own: str, other: str, names: list[str]) -> DataFrame:
        salt = F.pmod(F.xxhash64(*names, *keys), F.lit(salts)).cast("int")
        return side.where((F.col("_n0") > 0) & (F.col("_n1") > 0)).select(
            *keys, *names, salt.alias(own), F.explode(grid).alias(other))

    met = dealt(hot_left, "_a", "_b", others[0]).join(dealt(hot_right, "_b", "_a", others[1]), [*keys, "_a", "_b"]).drop("_a", "_b")
    alone_left = hot_left.where(F.col("_n1") == 0).drop("_n0", "_n1").unionByName(left.where(~known))
    alone_right = hot_right.where(F.col("_n0") == 0).drop("_n0", "_n1").unionByName(right.where(~known))
    out = full_outer_merge(cold_left, cold_right, keys).unionByName(met)
    for part in (alone_left, alone_right):
        out = out.unionByName(part, allowMissingColumns=True)
    return out.select(*keys, *others[0], *others[1])
