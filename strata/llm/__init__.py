"""Operators of a training-data pipeline over the text, vector, page and chat tables.

Functions that run inside tasks are pickled by value, so executors need
numpy and pyarrow but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
