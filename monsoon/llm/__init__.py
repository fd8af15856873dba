"""Training-data operators; nothing else in the library imports this subpackage.

Functions that tasks run are shipped by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
