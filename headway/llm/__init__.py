"""Operators for preparing training data, their registered queries and nothing the library needs.

The code that tasks run is sent along with them, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
