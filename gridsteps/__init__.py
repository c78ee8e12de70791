"""Gridded time-series tables and step-by-step exchange on PySpark.

Values live in long tables keyed by (variable, cell, band, year); cells,
bands, variable metadata and countries are small dimension tables.
"""

import sys

from pyspark import cloudpickle

# Functions of this package run in Python workers that need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
