"""tallyframe: business-analytics operators on Spark DataFrames.

Every operator takes DataFrames plus column names and returns a lazy
DataFrame built from built-in Spark SQL expressions, so Catalyst can push
filters and prune columns into the scans and whole-stage codegen keeps the
work in the JVM.
"""

from tallyframe.session import checkpoint_dir, get_session, scale_conf

__all__ = ["get_session", "checkpoint_dir", "scale_conf"]
