"""Text similarity over tables of documents and labelled pairs, on Spark."""

import sys

from pyspark import cloudpickle

# functions of this package travel with the job, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
