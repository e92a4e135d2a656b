"""Operators that prepare training text: filters, tokens, fingerprints, scores and duplicates.

Nothing outside this package imports it. Its task functions travel to the executors by value, so a
cluster needs no copy of the package, only numpy and pyarrow.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
