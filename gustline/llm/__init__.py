"""Operators for preparing text corpora; nothing else in the library imports this.

Functions that run in Python workers are sent by value, so a cluster needs the public
libraries on its workers but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
