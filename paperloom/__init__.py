"""paperloom: document analytics and corpus preparation on PySpark."""

import sys

from pyspark import cloudpickle

# Functions shipped to Python workers travel by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
