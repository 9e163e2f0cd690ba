"""Operators of a large-scale training-data pipeline.

One module per operator; ``queries`` holds the thin registered queries. No
module outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so a job runs
# there without the package being installed on every machine.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
