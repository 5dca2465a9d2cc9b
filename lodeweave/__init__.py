"""Spark-first engine for metadata knowledge graphs and training-data pipelines."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions that run on executors travel with their code: the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
