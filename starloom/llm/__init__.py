"""Operators for training-data pipelines over `documents`, `embeddings` and `labels`.

Functions of this package travel to the executors by value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
