"""State histories: previous values, state changes, as-of state, first-to-first gaps.

A history is a bag of rows (key, time, state).  Per-key sequential logic is
done with window functions, but never with one window partition per key: a
single key may hold a large share of all rows.  ``previous_in_sequence``
windows over (key, split) slices, where the split is a coarse, monotone
function of the ordering column (by default the day), and carries the last
row of each slice over to the next slice through a small per-slice table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.calendar import days_between


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _slice_columns(df: DataFrame, keys: list[str], split: Column) -> tuple[dict[str, Column], list[str], list[str]]:
    """The slice of a row as non-NULL primitive columns: every key column and
    the split become (value with NULL replaced, is-NULL flag) pairs.

    Partitioning, grouping and joining on them treats a NULL key (or a NULL
    time) as one group, as a window partition does, while the hand-over join
    stays a plain equi-join on the window's own partitioning (no reshuffle)
    and sorts stay on primitive columns.  Returns (columns to add, key column
    names, split column names).
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def pair(name: str, col: Column, dtype: str | None) -> dict[str, Column]:
        if dtype in (None, "date") or (dtype or "").startswith("timestamp"):
            fill = F.lit("1970-01-01").cast(dtype or "date")
        elif dtype == "string":
            fill = F.lit("")
        elif dtype == "boolean":
            fill = F.lit(False)
        else:
            fill = F.lit(0).cast(dtype)
        return {f"{name}_v": F.coalesce(col, fill), f"{name}_n": col.isNull()}

    cols: dict[str, Column] = {}
    key_names = []
    for i, k in enumerate(keys):
        cols.update(pair(f"_k{i}", F.col(k), types[k]))
        key_names += [f"_k{i}_v", f"_k{i}_n"]
    split_type = df.select(split.alias("s")).schema["s"].dataType.simpleString()
    cols.update(pair("_s", split, split_type))
    return cols, key_names, ["_s_n", "_s_v"]


def _split_order(ascending: bool = True) -> list[Column]:
    """Slices in time order: the NULL split (rows without a time) first, as
    NULLs sort first in an ascending window."""
    if ascending:
        return [F.col("_s_n").desc(), F.col("_s_v").asc()]
    return [F.col("_s_n").asc(), F.col("_s_v").desc()]


def previous_in_sequence(df: DataFrame, keys, order_cols, value_cols, prefix: str = "prev_",
                         split: Column | None = None, direction: str = "previous") -> DataFrame:
    """Add ``prefix + v`` = the value of ``v`` on the previous row of the same
    key (``direction="next"``: on the following row).

    Rows are ordered by ``order_cols`` (the first one is the time).  ``split``
    must be non-decreasing along that order within a key (default: the day of
    the first order column).  The heavy window runs per (key, split) slice, so
    a key with a third of all rows is spread over many tasks; the hand-over
    between slices goes through one row per slice (its last row, or its first
    for "next"), looked up with a lag over slices (bounded by the number of
    slices of a key).
    """
    keys, order_cols, value_cols = _cols(keys), _cols(order_cols), _cols(value_cols)
    forward = direction == "previous"
    if split is None:
        split = F.to_date(F.col(order_cols[0]))
    carried = F.struct(*[F.col(v).alias(v) for v in value_cols])
    slice_cols, kc, sc = _slice_columns(df, keys, split)
    sliced = df.withColumns({**slice_cols, "_carried": carried})

    # The carried values break remaining ties, so the window order and the
    # edge rows agree on one total order (and a recomputed task agrees too).
    ordering = [*order_cols, "_carried"]
    asc = [F.col(c).asc() for c in ordering]
    desc = [F.col(c).desc() for c in ordering]
    in_slice = Window.partitionBy(*kc, *sc).orderBy(*(asc if forward else desc))
    local = sliced.withColumn("_prev", F.lag("_carried").over(in_slice))

    # Edge row of every slice, then the neighbouring slice's edge row per slice.
    # This is a second read of the input, but an aggregate with a map-side
    # partial step: only one row per (key, slice) and map task is shuffled,
    # where sharing the window's output would need a second full shuffle.
    position = F.struct(*[F.col(c) for c in ordering])
    edge = F.max_by("_carried", position) if forward else F.min_by("_carried", position)
    tails = sliced.groupBy(*kc, *sc).agg(edge.alias("_tail"))
    over_slices = Window.partitionBy(*kc).orderBy(*_split_order(forward))
    tails = tails.withColumn("_handover", F.lag("_tail").over(over_slices)).select(*kc, *sc, "_handover")

    joined = local.join(tails, on=[*kc, *sc], how="left")
    prev = F.coalesce(F.col("_prev"), F.col("_handover"))
    out = joined.withColumns({prefix + v: prev[v] for v in value_cols})
    return out.drop(*slice_cols, "_carried", "_prev", "_handover")


def neighbours_in_sequence(df: DataFrame, keys, order_cols, prev_cols, next_cols,
                           prev_prefix: str = "prev_", next_prefix: str = "next_",
                           split: Column | None = None) -> DataFrame:
    """``previous_in_sequence`` and its "next" form in one pass: one window
    over the (key, split) slices gives lag and lead, one aggregate gives each
    slice's first and last row, one window over the slices hands them over."""
    keys, order_cols = _cols(keys), _cols(order_cols)
    prev_cols, next_cols = _cols(prev_cols), _cols(next_cols)
    if split is None:
        split = F.to_date(F.col(order_cols[0]))
    slice_cols, kc, sc = _slice_columns(df, keys, split)
    sliced = df.withColumns({**slice_cols,
                             "_cp": F.struct(*[F.col(v).alias(v) for v in prev_cols]),
                             "_cn": F.struct(*[F.col(v).alias(v) for v in next_cols])})
    ordering = [*order_cols, "_cp", "_cn"]  # carried values break remaining ties
    in_slice = Window.partitionBy(*kc, *sc).orderBy(*[F.col(c) for c in ordering])
    local = sliced.withColumns({"_lp": F.lag("_cp").over(in_slice), "_ln": F.lead("_cn").over(in_slice)})
    position = F.struct(*[F.col(c) for c in ordering])
    edges = sliced.groupBy(*kc, *sc).agg(F.max_by("_cp", position).alias("_last"),
                                          F.min_by("_cn", position).alias("_first"))
    over = Window.partitionBy(*kc).orderBy(*_split_order())
    edges = edges.select(*kc, *sc, F.lag("_last").over(over).alias("_hp"),
                         F.lead("_first").over(over).alias("_hn"))
    out = local.join(edges, on=[*kc, *sc], how="left")
    p, n = F.coalesce(F.col("_lp"), F.col("_hp")), F.coalesce(F.col("_ln"), F.col("_hn"))
    out = out.withColumns({**{prev_prefix + v: p[v] for v in prev_cols},
                           **{next_prefix + v: n[v] for v in next_cols}})
    return out.drop(*slice_cols, "_cp", "_cn", "_lp", "_ln", "_hp", "_hn")


def sequence_number(df: DataFrame, keys, order_cols, out_col: str = "seq_no",
                    split: Column | None = None) -> DataFrame:
    """1-based position of each row within its key in ``order_cols`` order.

    The rows are dealt by (key, split) slice once.  A row number within each
    slice is offset by the number of rows in the key's earlier slices, a
    running sum over the per-slice counts, of which a key has no more than the
    calendar has slices.  Rows and counts read the same exchange, so ``df``
    itself is computed once, and nothing is written or started here.
    """
    keys, order_cols = _cols(keys), _cols(order_cols)
    if split is None:
        split = F.to_date(F.col(order_cols[0]))
    slice_cols, kc, sc = _slice_columns(df, keys, split)
    dealt = df.withColumns(slice_cols).repartition(*kc, *sc)
    local = dealt.withColumn("_rn", F.row_number().over(
        Window.partitionBy(*kc, *sc).orderBy(*[F.col(c) for c in order_cols])))
    # An odd number is never 0: all rows are counted, by all their columns, so
    # that the counts ask the exchange for what the rows ask it for, and Spark
    # sees that it is one.
    every = F.xxhash64(*[F.col(c) for c in dealt.columns]).bitwiseOR(F.lit(1).cast("long")) != 0
    counts = dealt.groupBy(*kc, *sc).agg(F.count_if(every).alias("_cnt"))
    before = Window.partitionBy(*kc).orderBy(*_split_order()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0))).drop("_cnt")
    return (local.join(offsets, on=[*kc, *sc], how="left")
            .withColumn(out_col, (F.col("_rn") + F.col("_off")).cast("int"))
            .drop(*slice_cols, "_rn", "_off"))


def state_changes(df: DataFrame, key, time_col: str, state_col: str, tie_cols: Sequence[str] = (),
                  split: Column | None = None, out_col: str = "prev_change_time") -> DataFrame:
    """Add ``out_col`` = previous row's time when the state differs from it.

    NULL when the previous row has the same state, and on a key's first row.
    Equality is SQL equality: a NULL state on either side is not "the same",
    so the previous time is kept.
    """
    prev = previous_in_sequence(df, key, [time_col, *tie_cols], [state_col, time_col],
                                prefix="_p_", split=split)
    same = F.col("_p_" + state_col) == F.col(state_col)
    return (prev.withColumn(out_col, F.when(same, F.lit(None)).otherwise(F.col("_p_" + time_col)))
            .drop("_p_" + state_col, "_p_" + time_col))


def change_gaps(df: DataFrame, key, time_col: str, state_col: str, tie_cols: Sequence[str] = (),
                split: Column | None = None, out_col: str = "gap_days") -> DataFrame:
    """Rows that follow a state change, with the days since the previous row."""
    marked = state_changes(df, key, time_col, state_col, tie_cols, split, "_chg")
    return (marked.where(F.col("_chg").isNotNull())
            .withColumn(out_col, days_between(F.col(time_col), F.col("_chg")))
            .drop("_chg"))


def as_of_state(df: DataFrame, key, time_col: str, state_cols, as_of, tie_cols: Sequence[str] = ()) -> DataFrame:
    """The latest row per key with ``time <= as_of``: one row per key.

    ``max_by`` is a partial aggregate, so a hot key is reduced map-side.
    ``tie_cols`` break ties between rows of the same time (largest wins).
    """
    keys, state_cols = _cols(key), _cols(state_cols)
    latest = F.max_by(F.struct(*[F.col(c) for c in state_cols]),
                      F.struct(F.col(time_col), *[F.col(c) for c in tie_cols]))
    return (df.where(F.col(time_col) <= as_of)
            .groupBy(*keys).agg(latest.alias("_s"))
            .select(*keys, *[F.col("_s")[c].alias(c) for c in state_cols]))


def state_calendar(df: DataFrame, key, time_col: str, state_col: str, tie_cols: Sequence[str] = (),
                   out_col: str = "n_keys") -> DataFrame:
    """(day, state, n): how many keys hold each state at the end of every day
    from the first to the last of the data; states that nobody holds have no row.

    Instead of an as-of join per day: a key adds one to its new state and takes
    one from its last on the days on which it changes, and the sums of these by
    day and state are accumulated over the calendar.  The per-key window spans
    the key's active days, all that follows is days times states.  A NULL key
    or state is one like any other; rows without a time hold nothing.
    """
    keys = _cols(key)
    last = F.max_by(F.struct(F.col(state_col).alias("state")), F.struct(F.col(time_col), *[F.col(c) for c in tie_cols]))
    daily = (df.where(F.col(time_col).isNotNull())
             .groupBy(*keys, F.to_date(time_col).alias("day")).agg(last.alias("_now")))
    before = F.lag("_now").over(Window.partitionBy(*keys).orderBy("day"))
    moved = daily.withColumn("_before", before).where(~F.col("_now").eqNullSafe(F.col("_before")))
    events = F.array_compact(F.array(
        F.struct(F.col("_now.state").alias("state"), F.lit(1).alias("n")),
        F.when(F.col("_before").isNotNull(), F.struct(F.col("_before.state").alias("state"), F.lit(-1).alias("n")))))
    changes = moved.select("day", F.inline(events)).groupBy("day", "state").agg(F.sum("n").alias("n"))
    end = df.agg(F.to_date(F.max(time_col))).scalar()
    per_state = changes.groupBy("state").agg(
        F.map_from_entries(F.collect_list(F.struct("day", "n"))).alias("_n"), F.min("day").alias("_first"))
    spine = per_state.select("state", "_n", F.explode(F.sequence("_first", end)).alias("day"))
    upto = Window.partitionBy("state").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = spine.withColumn(out_col, F.sum(F.coalesce(F.try_element_at("_n", F.col("day")), F.lit(0))).over(upto))
    return held.where(F.col(out_col) > 0).select("day", F.col("state").alias(state_col), out_col)


def first_to_first_days(df: DataFrame, key, time_col: str, state_col: str, from_state, to_state,
                        out_col: str = "days") -> DataFrame:
    """Days from the first ``from_state`` row to the first ``to_state`` row per key.

    One pass (``min`` of a conditional) instead of a self-join, so no pairs are
    built within a key.  Keys lacking either state are dropped, as an inner
    join of the two filtered sides would.
    """
    keys = _cols(key)
    t = F.col(time_col)
    per_key = (df.where(F.col(state_col).isin(from_state, to_state))
               .groupBy(*keys)
               .agg(F.min(F.when(F.col(state_col) == from_state, t)).alias("_from"),
                    F.min(F.when(F.col(state_col) == to_state, t)).alias("_to")))
    return (per_key.where(F.col("_from").isNotNull() & F.col("_to").isNotNull())
            .select(*keys, days_between("_to", "_from").alias(out_col)))


def transitions(df: DataFrame, key, time_col: str, state_col: str, from_state, to_state,
                tie_cols: Sequence[str] = (), split: Column | None = None) -> DataFrame:
    """Rows whose previous row (same key) is ``from_state`` and which are ``to_state``."""
    prev = previous_in_sequence(df, key, [time_col, *tie_cols], [state_col], prefix="_p_", split=split)
    return (prev.where((F.col("_p_" + state_col) == from_state) & (F.col(state_col) == to_state))
            .drop("_p_" + state_col))
