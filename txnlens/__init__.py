"""txnlens: session and transaction risk analytics as PySpark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to executors by value, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
