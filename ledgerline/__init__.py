"""Table quality, features, statistics and tabular models as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their job: workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
