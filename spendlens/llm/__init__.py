"""Training-data operators: one module per operator, ``checks`` registers their queries."""

import sys

from pyspark import cloudpickle

# Workers get these functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
