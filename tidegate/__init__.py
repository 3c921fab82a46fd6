"""Text preparation, guardrails and retrieval as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with the job; executors need no install
cloudpickle.register_pickle_by_value(sys.modules[__name__])
