"""tidemark: a PySpark-native engine for social-post signals and text-corpus preparation."""

import sys

from pyspark import cloudpickle

# Functions shipped to executors travel with the task, so a cluster needs no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
