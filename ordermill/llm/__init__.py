"""Operators for building training corpora.

Every operator is a function over DataFrames.  Its functions travel to the
executors by value, so a cluster needs numpy, pyarrow and the named codecs on
its workers, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
