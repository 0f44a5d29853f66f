"""outcomekit: binary-outcome analytics on Spark DataFrames.

Profiling, cleaning, encoding, splitting, balancing, training, evaluation and
model comparison, written as DataFrame expressions and ``pyspark.ml`` stages.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package that run in Python workers travel with their code: executors need not have
# the package, nor be started from its folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
