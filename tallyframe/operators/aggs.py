"""Grouped counts, shares, arg-max with ties, ordered lists, rank percentiles."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.text import counted_label


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def share_of_total(df: DataFrame, value_col: str, out_col: str = "percentage",
                   scale: float = 100.0) -> DataFrame:
    """Add ``value * scale / total`` where total sums ``value_col`` over all rows.

    The total is an uncorrelated scalar subquery (its own small aggregation
    job), not an un-partitioned window, so rows are never gathered into one task.
    """
    total = df.agg(F.sum(value_col)).scalar()
    return df.withColumn(out_col, F.try_divide(F.col(value_col) * F.lit(scale), total))


def rate(numerator: Column, denominator: Column, scale: float = 100.0) -> Column:
    """``numerator * scale / denominator`` as a double (NULL for a zero denominator)."""
    return F.try_divide(numerator * F.lit(scale), denominator)


def arg_max_ties(df: DataFrame, value_col: str) -> DataFrame:
    """All rows whose ``value_col`` equals the maximum (ties kept)."""
    top = df.agg(F.max(value_col)).scalar()
    return df.where(F.col(value_col) == top)


def top_value(df: DataFrame, value_col: str, out_col: str | None = None) -> DataFrame:
    """The single largest value as a one-row frame (ORDER BY … DESC LIMIT 1)."""
    return df.agg(F.max(value_col).alias(out_col or value_col))


def ordered_list(df: DataFrame, group_cols, item_col: str, order_col: str | None = None,
                 sep: str = ",", out_col: str = "items") -> DataFrame:
    """Per group, the items joined by ``sep`` in ``order_col`` order.

    Groups hold one row per item (pre-aggregate first), so the list is as long
    as the output string itself.
    """
    group_cols = _cols(group_cols)
    order_col = order_col or item_col
    pairs = F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(item_col).alias("i"))))
    return df.groupBy(*group_cols).agg(F.array_join(F.transform(pairs, lambda s: s["i"]), sep).alias(out_col))


def ordered_list_in_slices(df: DataFrame, group_cols, item_col: str, order_col: str | None = None, sep: str = ",",
                           out_col: str = "items", slices: int = 200) -> DataFrame:
    """``ordered_list`` for groups that may hold a large share of all rows.

    The rows are dealt by ranges of (group, order), so a slice holds about
    1/``slices`` of all rows wherever they come from.  Each slice joins its
    own items, and a group's texts are then put one behind the other: no task
    holds more rows than a slice, and the last step only the list itself,
    which, being one value, can't pass 2 GB.  Equal places in the order go by
    the item.
    """
    group_cols = _cols(group_cols)
    order_col = order_col or item_col
    dealt = df.repartitionByRange(slices, *group_cols, order_col).withColumn("_slice", F.spark_partition_id())
    parts = ordered_list(dealt, [*group_cols, "_slice"], item_col, order_col, sep, "_part")
    return ordered_list(parts, group_cols, "_part", "_slice", sep, out_col)


def counted_items(df: DataFrame, group_cols, item_col: str, sep: str = ",",
                  out_col: str = "items") -> DataFrame:
    """Per group the distinct items, 'nxitem' when an item occurs n > 1 times,
    ordered by item."""
    group_cols = _cols(group_cols)
    counts = df.groupBy(*group_cols, item_col).agg(F.count("*").alias("_n"))
    labelled = counts.withColumn("_label", counted_label("_n", item_col))
    return ordered_list(labelled, group_cols, "_label", order_col=item_col, sep=sep, out_col=out_col)


def counted_items_by_kind(df: DataFrame, group_cols, item_col: str, kind_col: str,
                          kinds: Mapping[str, object], sep: str = ",") -> DataFrame:
    """``counted_items`` for several kinds of row at once.

    For each ``out_col -> kind`` the counted, item-ordered list of the rows of
    that kind (NULL when the group has none), for every group having a row of
    any listed kind.  Same result as one ``counted_items`` per kind merged by
    a full outer join, in one pass: counts per (group, item, kind), then one
    list per group.
    """
    group_cols = _cols(group_cols)
    names = list(kinds)
    counts = (df.where(F.col(kind_col).isin(list(kinds.values())))
              .groupBy(*group_cols, item_col)
              .agg(*[F.count_if(F.col(kind_col) == kinds[n]).alias(f"_n{i}") for i, n in enumerate(names)]))
    packed = F.sort_array(F.collect_list(F.struct(F.col(item_col).alias("i"),
                                                  *[F.col(f"_n{i}").alias(f"n{i}") for i in range(len(names))])))
    grouped = counts.groupBy(*group_cols).agg(packed.alias("_all"))
    def kind_list(field: str) -> Column:
        present = F.filter("_all", lambda x: x[field] > 0)
        labels = F.transform(present, lambda x: counted_label(x[field], x["i"]))
        return F.when(F.size(present) > 0, F.array_join(labels, sep))

    outs = [kind_list(f"n{i}").alias(n) for i, n in enumerate(names)]
    return grouped.select(*group_cols, *outs)


def rank_percentiles(df: DataFrame, group_cols, value_col: str, percentiles: Mapping[str, float | str | Decimal]) -> DataFrame:
    """Rank-based percentiles per group: for each ``name -> p`` the mean of the
    values at 1-based ranks floor(n·p) and ceil(n·p) of the group's ascending
    order (rank 0 does not exist, so for n·p < 1 only rank ceil(n·p) counts).
    ``p`` is multiplied as an exact decimal.  NULL values are not ranked.
    Numbers of any type give doubles, dates and timestamps the days and
    microseconds since 1970.

    The rows are first reduced to a histogram (group, value, count) with a
    partial aggregate; see ``rank_percentiles_from_histogram``.
    """
    group_cols = _cols(group_cols)
    hist = (df.where(F.col(value_col).isNotNull())
            .groupBy(*group_cols, value_col).agg(F.count("*").alias("_cnt")))
    return rank_percentiles_from_histogram(hist, group_cols, value_col, "_cnt", percentiles)


SPLITTERS = 1024


def _bucket(value: Column, splitters: Column, size: int) -> Column:
    """How many of the ascending ``splitters`` (NULL-free, at most ``size``) are at most ``value``: a binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(size.bit_length()))])

    def step(at: Column, by: Column) -> Column:
        return F.when((at + by <= F.size(splitters)) & (F.try_element_at(splitters, at + by) <= value), at + by).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def _number(value: Column, dtype: str) -> Column:
    """A value as what percentiles are means of."""
    if dtype == "date":
        return F.unix_date(value)
    if dtype.startswith("timestamp"):  # of the value as it reads, without a zone shift
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(dtype), value)
    if dtype in ("string", "binary", "boolean") or "<" in dtype:
        raise ValueError(f"percentiles need a number, a date or a timestamp, not {dtype}")
    return value


def rank_percentiles_from_histogram(hist: DataFrame, group_cols, value_col: str, count_col: str,
                                    percentiles: Mapping[str, float | str | Decimal], splitters: int = SPLITTERS) -> DataFrame:
    """``rank_percentiles`` over a histogram (group, value, count of rows).

    Selection by narrowing.  About ``splitters`` values that cut the histogram's
    rows into equal shares (one small aggregate) deal every row to a bucket of
    neighbouring values.  The counts per (group, bucket), at most as many a
    group as there are splitters, tell in which buckets the wanted ranks lie;
    only the rows of those, two for each percentile at most, are ranked one by
    one.  So no window spans more than the splitters, or than a share of
    1/splitters of the histogram, however many values a group has.  The
    branches read the histogram through one exchange.
    """
    group_cols = _cols(group_cols)
    value = _number(F.col(value_col), hist.schema[value_col].dataType.simpleString())
    # A null group is a group: (value, is NULL) pairs join as plain equality.
    keys = {f"_g{i}": F.col(c) for i, c in enumerate(group_cols)}
    rows = hist.select(*[c.alias(k) for k, c in keys.items()], value.alias("_v"), F.col(count_col).alias("_c"))
    shares = F.expr("array(" + ",".join(f"{(i + 1) / (splitters + 1)!r}D" for i in range(splitters)) + ")")
    # the count takes part, so that this branch reads what the others read
    cuts = rows.agg(F.array_sort(F.array_distinct(F.array_compact(F.percentile_approx("_v", shares, 2 * splitters)))).alias("cuts"), F.max("_c").alias("c"))
    cuts = cuts.select(F.struct("cuts", "c")).scalar()["cuts"]
    # a column first, for functions over arrays can't hold a subquery
    dealt = rows.withColumn("_cuts", cuts).withColumn("_b", _bucket(F.col("_v"), F.col("_cuts"), splitters)).drop("_cuts")
    counts = dealt.groupBy(*keys, "_b").agg(F.sum("_c").alias("_s"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({"_before": F.coalesce(F.sum("_s").over(before), F.lit(0)),
                                 "_n": F.sum("_s").over(Window.partitionBy(*keys))})
    wanted = None
    for rank in (r for p in percentiles.values() for r in _ranks(F.col("_n"), p)):
        hit = rank.between(F.col("_before") + 1, F.col("_before") + F.col("_s"))
        wanted = hit if wanted is None else wanted | hit
    go_on = counts.where(wanted).select(*[F.col(k).alias(f"_w{k}") for k in keys], F.col("_b").alias("_wb"), "_before", "_n")
    same = F.col("_b") == F.col("_wb")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_w{k}"))
    narrowed = dealt.join(go_on, same)
    upto = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hi = F.col("_before") + F.sum("_c").over(upto)
    ranked = narrowed.select(*keys, "_v", (hi - F.col("_c") + 1).alias("_lo"), hi.alias("_hi"), "_n")
    out = _percentiles_from_ranks(ranked, list(keys), "_v", percentiles)
    return out.select(*[F.col(k).alias(c) for k, c in zip(keys, group_cols)], *percentiles)


def _ranks(n: Column, p: float | str | Decimal) -> tuple[Column, Column]:
    """floor(n·p) and ceil(n·p) of the exact decimal product."""
    at = n * F.lit(Decimal(str(p)))
    return F.floor(at).cast("long"), F.ceil(at).cast("long")


def _percentiles_from_ranks(cum: DataFrame, group_cols, value_col: str,
                            percentiles: Mapping[str, float | str | Decimal]) -> DataFrame:
    """Per group, the rank percentiles from rows (group, value, _lo, _hi, _n)."""
    group_cols = _cols(group_cols)
    # Target ranks once per row (exact decimal n·p), then plain comparisons.
    ranks = {}
    for i, p in enumerate(percentiles.values()):
        ranks[f"_kf{i}"], ranks[f"_kc{i}"] = _ranks(F.col("_n"), p)
    cum = cum.withColumns(ranks)
    aggs = []
    for i in range(len(percentiles)):
        kf, kc = F.col(f"_kf{i}"), F.col(f"_kc{i}")
        hit_f = kf.between(F.col("_lo"), F.col("_hi"))
        hit_c = kc.between(F.col("_lo"), F.col("_hi"))
        aggs += [F.max(F.when(hit_f, F.col(value_col))).alias(f"_f{i}"),
                 F.max(F.when(hit_c, F.col(value_col))).alias(f"_c{i}"),
                 F.max(kf == kc).alias(f"_same{i}")]
    per_group = cum.groupBy(*group_cols).agg(*aggs)
    outs = []
    for i, name in enumerate(percentiles):
        f, c = F.col(f"_f{i}").cast("double"), F.col(f"_c{i}").cast("double")
        outs.append(F.when(F.col(f"_same{i}") | f.isNull(), c).otherwise((f + c) / 2).alias(name))
    return per_group.select(*group_cols, *outs)


def _int_div(a: Column, b: Column) -> Column:
    """Exact integer division of non-negative longs or whole decimals; the quotient is a long."""
    return F.call_function("div", a, b)


def _whole(c: Column) -> Column:
    """Room for totals and their multiples far beyond a long; a mean itself has to fit one, in units of its last digit."""
    return c.cast("decimal(30,0)")


def percent_half_up(numerator: Column, denominator: Column, digits: int = 1) -> Column:
    """``round(numerator * 100 / denominator, digits)`` rounded half away from
    zero on the exact quotient (integer arithmetic, no binary-float ties).
    Both arguments are non-negative counts."""
    scale = 10 ** digits
    d = denominator.cast("long")
    value = _int_div(_whole(numerator) * (200 * scale) + d, _whole(d) * 2) / F.lit(float(scale))
    return F.when(d > 0, value)  # NULL for an empty input, as SQL division by zero


def mean_half_up(total: Column, count: Column, digits: int = 2) -> Column:
    """``round(total / count, digits)`` half away from zero on the exact
    quotient of two integers (sign handled separately)."""
    scale = 10 ** digits
    c = count.cast("long")
    mag = _int_div(F.abs(_whole(total)) * (2 * scale) + c, _whole(c) * 2)
    return F.when(c > 0, F.signum(total.cast("double")) * mag / F.lit(float(scale)))
