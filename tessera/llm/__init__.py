"""Training-data operators: filters, mixing, dedup, scoring and output formats.

Nothing else in the library imports this subpackage.  Its functions travel to
the executors by value, so a cluster needs no copy of the code on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
