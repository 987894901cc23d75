"""Operators of a training-data pipeline: archives, filters, joins, packing, search.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Python workers get the functions of this package with the task, so that they
# need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
