"""Declared-schema frames from literal rows (seed tables and test fixtures).

Values are given as text the way an INSERT script writes them and are
coerced to the declared types with ``try_cast`` semantics left to the
caller: here a bad literal raises (ANSI cast), because fixtures must be clean.
"""

from __future__ import annotations

import re

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def frame(spark: SparkSession, ddl: str, rows: Iterable[Sequence]) -> DataFrame:
    """Build a frame from rows of strings/None and a DDL schema string.

    ``ddl`` is e.g. ``"runner_id int, registration_date date"``; every value is
    first loaded as a string (or NULL) and then cast to its declared type.
    """
    fields = [f.strip().split(None, 1) for f in re.split(r",(?![^()]*\))", ddl)]
    names = [f[0] for f in fields]
    types = [f[1] for f in fields]
    as_text = [tuple(None if v is None else str(v) for v in r) for r in rows]
    raw = spark.createDataFrame(as_text, ", ".join(f"{n} string" for n in names))
    return raw.select(*[F.col(n).cast(t).alias(n) for n, t in zip(names, types)])
