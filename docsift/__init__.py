"""docsift: document retrieval as Spark DataFrame plans.

files -> elements -> clean text -> chunks -> vectors and postings -> search.
"""

import sys

from pyspark import cloudpickle

# Functions handed to executors travel with the task, so a cluster needs no
# installed copy of this package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
