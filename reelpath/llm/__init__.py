"""Operators for building training corpora, one module per operator.

Nothing else in the library imports this package.  Functions that run inside
Python workers are shipped by value, so an executor needs numpy and pyarrow
but not this package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
