"""Document-ledger analytics as PySpark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
