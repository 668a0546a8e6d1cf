"""Operators for preparing large text collections for model training.

Nothing else in the library imports this subpackage.  Its functions travel
to the executors with the plan, so these need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
