"""Paged API responses to tables, as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

from pageloom.operators.joins import JoinSpec, multi_join
from pageloom.operators.links import LinkSpec
from pageloom.operators.parse import ParseSpec, parse
from pageloom.plans.run import Ingest

# The few functions that run in Python workers travel with the job, so executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Ingest", "JoinSpec", "LinkSpec", "ParseSpec", "multi_join", "parse"]
