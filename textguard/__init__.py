"""textguard: Spark-native operators for building and policing text-moderation corpora.

Every operator is a plain function ``DataFrame -> DataFrame`` (or returns a
small aggregate DataFrame); nothing on the data path is collected to the driver.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value: they need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
