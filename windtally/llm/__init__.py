"""Operators for large training-data pipelines.  Nothing else in the library
imports this subpackage.

Functions that run on executors travel by value, so executors need only the
public Python packages, not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
