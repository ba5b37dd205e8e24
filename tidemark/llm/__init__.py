"""Operators for preparing training text: mixing, encoding, search, scoring, cleaning.

Functions of this package that run in tasks travel with them, by value, so that
executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
