"""Structured Streaming forms: ledger balances and allocations (the "real-time" option), and the validated append."""

from tallyframe.streaming.allocation import month_peaks_stream
from tallyframe.streaming.append import append_verdicts, dropped_late, validated_stream
from tallyframe.streaming.balances import daily_net_stream, ledger_stream, live_balances, start

__all__ = ["month_peaks_stream", "append_verdicts", "dropped_late", "validated_stream", "daily_net_stream", "ledger_stream",
           "live_balances", "start"]
