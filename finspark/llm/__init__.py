"""Training-data operators: decontamination, near-duplicate joins, token scans,
substring removal, quality and toxicity models, chat windows, mixing, licenses, centroid
clustering, SimHash near-duplicates, conversation tries.

Functions that run in Python workers are shipped by value, so that executors need
no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
