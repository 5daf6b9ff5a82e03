"""Training-data operators (quality, decontamination, sharding, dedup,
language, joins, archives, mixing, extraction) over Spark DataFrames.

Nothing outside this subpackage imports it.  Functions that run inside
Python workers are shipped by value, so executors need no copy of the
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
