"""Churn-style tabular analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from ebbtide.spec import CHURN, DatasetSpec

# Task functions carry their helpers along, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["CHURN", "DatasetSpec"]
