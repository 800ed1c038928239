"""Event and trip analytics as plain PySpark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Send the code of our few Python tasks along with each task, so that executors
# need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
