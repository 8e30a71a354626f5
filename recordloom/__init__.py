"""Record tables on Spark: queries, relationships, upserts, snapshots and attachments."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with their job, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
