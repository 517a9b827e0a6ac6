"""Training-data operators: one module per operator, their queries in ``queries``."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the workers by value: they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
