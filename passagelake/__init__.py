"""Document-retrieval tables on Spark: pages -> chunks -> vectors -> index -> hits -> prompts."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along, so that the package need not
# be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
