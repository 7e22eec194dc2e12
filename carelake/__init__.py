"""carelake: healthcare claims, records and retrieval operators as PySpark DataFrame functions."""

import sys

from pyspark import cloudpickle

# Ship the package's few Python helpers inside the tasks, so workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
