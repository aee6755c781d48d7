"""Operators for preparing language-model training data.

Python functions of this subpackage run inside Spark tasks. They are sent to the
workers by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
