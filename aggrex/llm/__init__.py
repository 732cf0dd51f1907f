"""Operators of a training-data pipeline over ``documents``, ``embeddings``,
``pages`` and ``benchmark``.

Nothing else in the library imports this subpackage. Functions that run inside
Python tasks are pickled by value, so executors need only Spark and the public
packages (pyarrow, numpy, ...), not this library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules["aggrex"])
