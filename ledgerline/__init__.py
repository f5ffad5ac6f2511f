"""ledgerline: a Spark-native retail lakehouse (ingest, data quality, Gold
tables, scoring, insights, retrieval)."""

import sys

from pyspark import cloudpickle

# Functions from this package that run inside tasks (mapInPandas hooks, the
# kNN scorer) are shipped by value, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
