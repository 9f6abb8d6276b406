"""weftline: web pages and raw documents in, cleaned and sharded corpora out, on Spark."""

import sys

from pyspark import cloudpickle

# Arrow functions of this package travel to executors by value, so a job needs no --py-files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
