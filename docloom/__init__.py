"""docloom: a document-analytics engine on the Spark DataFrame, SQL and Structured Streaming APIs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions of this package travel to the executors by value: a cluster needs no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
