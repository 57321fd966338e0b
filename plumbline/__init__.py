"""Search and maintenance of large document tables as Spark jobs."""

import sys

from pyspark import cloudpickle

# Helpers that run inside tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
