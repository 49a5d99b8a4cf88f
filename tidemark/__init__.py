"""Tidemark: analytics over repeated measurements, and text-corpus preparation, as PySpark DataFrame jobs."""

from pyspark import cloudpickle

import tidemark as _self

# Functions sent to executors travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(_self)
