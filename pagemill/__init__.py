"""Batch jobs over crawled pages, articles and reader logs, as DataFrame functions."""

import sys

from pyspark import cloudpickle

# Send Python functions to executors by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
