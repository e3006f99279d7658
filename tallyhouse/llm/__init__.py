"""Operators of a training-data pipeline: language, copies, leaks, mixing, chat, web pages, vectors.

Functions that run in Python on executors travel by value, so a cluster needs
numpy, pandas and pyarrow on its workers but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
