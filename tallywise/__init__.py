"""Reconciliation, profiling and enrichment of DataFrames on Spark."""

import sys

from pyspark import cloudpickle

from tallywise.plans.comparison import Comparison, compare
from tallywise.plans.flows import compare_batches, compare_files, compare_queries

__all__ = ["Comparison", "compare", "compare_batches", "compare_files", "compare_queries"]

# Functions of this package travel to the Python workers with their code, so the
# executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
