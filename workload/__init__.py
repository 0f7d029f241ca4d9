"""Queries of the package over the given tables, each next to its SQL.

The tables stand in for a collection: an order is a binding, a line item a page
file or a request for one, an event an attempt or a run.
"""

import sys

from pyspark import cloudpickle

# Python workers get the functions themselves, so the package need not be
# installed or on the path of the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
