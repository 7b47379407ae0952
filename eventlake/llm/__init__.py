"""Training-data operators (text corpora, web archives, vectors).

Nothing outside this folder imports it.  Functions that run inside tasks are shipped by
value, so workers need no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
