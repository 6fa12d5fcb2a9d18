"""Operators for training-data preparation; nothing else in the library imports this folder.

Task code travels with the job, so executors need no copy of this folder.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
