"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage.

Tasks carry the code of this subpackage with them (pickled by value), so executors need no copy
of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
