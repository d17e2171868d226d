"""Operators of a training-data pipeline: dedup, mixing, formatting, filtering, packing and scoring of text corpora."""

import sys

from pyspark import cloudpickle

# Tasks get this subpackage's functions with the job, so executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
