"""Operators for preparing training data at scale: duplicates, archives, language, mixing, tokens, search."""

import sys

from pyspark import cloudpickle

# functions that run on executors travel with the plan, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
