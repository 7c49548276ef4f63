"""Operators a large-scale training-data pipeline needs, one module per operator.

Nothing outside this package imports it. Task functions are pickled by value, so
executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
