"""Harvest and maintain a digitised collection as Spark tables.

``functions``  column expressions on identifiers, paths, URLs and dates
``sources``    scans of listings, lists, manifests and archives
``operators``  table transformations (routing, batching, manifests, audit ...)
``plans``      whole jobs: listing run, download, update, publication, versions
``streaming``  the listing run as an incremental stream
"""

import sys

from pyspark import cloudpickle

# Python workers get the functions themselves, so the package need not be
# installed or on the path of the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
