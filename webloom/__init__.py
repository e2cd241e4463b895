"""webloom: web mining and text analytics as PySpark table operators."""

import sys

from pyspark import cloudpickle

# Functions that run inside Arrow batches travel to the executors with the job, so these need no
# copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
