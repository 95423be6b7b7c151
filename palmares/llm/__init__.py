"""Operators for preparing large text corpora, and their registered queries.

Nothing outside this folder imports it. Functions that run in Python workers are sent by
value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
