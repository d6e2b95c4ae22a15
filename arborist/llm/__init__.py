"""Operators for preparing training data, each built on Spark jobs.

Nothing else in the library imports this subpackage.  Its Python helpers
travel to the executors by value, so a cluster needs no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
