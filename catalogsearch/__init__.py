"""Index database metadata as documents and answer batches of questions on it, with Spark DataFrames."""

import sys

from pyspark import cloudpickle

from catalogsearch.options import Options

# Functions that run in tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Options"]
