"""waymark: Spark jobs for multi-turn, tool-using model trajectories."""

import sys

from pyspark import cloudpickle

# Functions go to Python workers by value, so the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
