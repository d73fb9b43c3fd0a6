"""Operators for large-scale training-data pipelines; nothing else in the library imports them.

Functions that run in tasks travel with their code, so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
