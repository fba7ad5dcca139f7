"""Operators for building language-model training corpora on Spark."""

import sys

from pyspark import cloudpickle

# Task functions carry their code, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
