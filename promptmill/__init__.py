"""Curation and model evaluation over prompt/response logs, as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# UDFs carry their own code to the executors, which need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
