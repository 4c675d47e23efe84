"""Training-data operators: ten Spark jobs over documents, benchmark and conversations."""

import sys

from pyspark import cloudpickle

# Python workers get the operators' functions with the task; nothing has to be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
