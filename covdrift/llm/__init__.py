"""Operators of a training-data pipeline; nothing outside this subpackage imports it.

Functions that run in Python workers are sent with their code, so workers need no copy of the
library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
