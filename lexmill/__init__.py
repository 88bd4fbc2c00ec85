"""Corpus analytics for legal and other structured documents on Spark DataFrames and streams."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with their code, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
