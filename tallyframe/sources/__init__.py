"""Table sources: parquet tables of a data folder and declared-schema literal frames."""

from tallyframe.sources.tables import TableSet, read_table
from tallyframe.sources.literal import frame

__all__ = ["TableSet", "read_table", "frame"]
