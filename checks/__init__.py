"""Messy inputs derived from the driver tables, the queries over them, and their SQL."""

import sys

from pyspark import cloudpickle

# The workbook fixture is built in tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
