"""Operators for preparing language-model training data, and their queries.

Nothing else in the library imports this package. Functions that run on workers are sent by value, so that executors
need the third-party packages but not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
