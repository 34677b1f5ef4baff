"""Training-data operators: one module per operator, their queries in ``queries``.

Functions that run inside executors are shipped by value, so workers need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
