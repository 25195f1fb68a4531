"""Operators for preparing training text: deduplication, filters, scoring, decontamination, packing.

Nothing else in the library imports this package.  Functions that run inside
tasks are shipped by value, so executors need numpy and pyarrow but not this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
