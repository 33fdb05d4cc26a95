"""Operators for preparing training corpora.

Functions of this package that run inside Arrow tasks are pickled by value, so
executors need numpy and pyarrow but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
