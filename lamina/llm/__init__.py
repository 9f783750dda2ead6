"""Operators for training-data pipelines over text tables.

Functions of this package that tasks call are sent along with them, so executors need not have it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
