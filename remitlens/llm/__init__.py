"""Operators of a training-data pipeline over document tables.

Thirteen operators, each in a module of its own, plus the registered queries
(``queries.py``). Nothing else in the library imports this package.

Functions that run in Python workers are shipped by value, so executors need
no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
