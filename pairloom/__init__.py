"""Pairloom: record linkage over product catalogs as Spark DataFrame plans.

Worker functions are pickled by value, so executors need only the installed Python libraries.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
