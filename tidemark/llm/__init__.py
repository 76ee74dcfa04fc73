"""Operators for building training corpora: dedup, sharding, filters, packing.

Nothing else in the library imports this subpackage. Its functions are shipped
to the executors by value, so a cluster needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
