"""textmill: prepare, search and score text corpora with Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Batch functions travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
