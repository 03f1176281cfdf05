"""Operators of a training-data pipeline, each built by one named method.

Nothing else in the library imports this subpackage.  ``queries`` registers one
query per operator; the operators themselves keep general interfaces.
"""

import sys

from pyspark import cloudpickle

#: Functions of this subpackage travel to the executors by value, so a cluster needs no copy of it there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
