"""Reusable DataFrame operators (each returns a lazy DataFrame)."""

from tallyframe.operators.aggs import (
    arg_max_ties, counted_items, counted_items_by_kind, mean_half_up, ordered_list,
    ordered_list_in_slices, percent_half_up, rank_percentiles, rank_percentiles_from_histogram, rate, share_of_total, top_value,
)
from tallyframe.operators.append import (
    accepted, append_batch, appended, manifests, read_batches, rejected, validate_candidates, validated_append,
)
from tallyframe.operators.billing import payment_schedule
from tallyframe.operators.distinct import bitmap_counts, distinct_bitmaps, merged_bitmaps
from tallyframe.operators.joins import (
    explode_array, explode_membership, full_outer_merge, member_join, salted_full_outer_merge,
)
from tallyframe.operators.ledger import (
    accumulated, allocation_of_peaks, balance_segments, daily_net, level_changes, month_end_balances, month_peaks,
    running_balance, signed_amount, trailing_changes, window_weighted_sum,
)
from tallyframe.operators.states import (
    as_of_state, change_gaps, first_to_first_days, neighbours_in_sequence, previous_in_sequence,
    sequence_number, state_calendar, state_changes, transitions,
)

__all__ = [
    "arg_max_ties", "counted_items", "counted_items_by_kind", "mean_half_up", "ordered_list",
    "ordered_list_in_slices",
    "percent_half_up", "rank_percentiles", "rank_percentiles_from_histogram", "rate", "share_of_total",
    "top_value", "accepted", "append_batch", "appended", "manifests", "read_batches", "rejected", "validate_candidates",
    "validated_append", "payment_schedule",
    "explode_array", "explode_membership", "full_outer_merge", "salted_full_outer_merge",
    "accumulated", "allocation_of_peaks", "level_changes", "month_peaks", "trailing_changes",
    "member_join", "balance_segments", "daily_net", "month_end_balances", "running_balance", "signed_amount",
    "window_weighted_sum", "as_of_state", "change_gaps", "first_to_first_days", "neighbours_in_sequence",
    "previous_in_sequence", "sequence_number", "state_calendar", "state_changes", "transitions", "bitmap_counts", "distinct_bitmaps",
    "merged_bitmaps",
]
