"""Operators for preparing training text at corpus scale.

Nothing outside this subpackage imports it.  Worker functions are pickled by
value, so executors need the installed Python libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
