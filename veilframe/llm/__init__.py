"""Operators of a training-data pipeline; nothing else in the library imports them."""

from pyspark import cloudpickle

import veilframe

# Tasks carry this code with them, so workers need not have it installed.
cloudpickle.register_pickle_by_value(veilframe)
