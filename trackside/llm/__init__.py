"""Operators for large text collections: search, duplicates, languages, personal data, sharding, mixing, packing.

The functions below run in Python workers too. They are sent there by value, so that workers need
the public libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
