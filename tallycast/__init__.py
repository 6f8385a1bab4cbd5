"""Daily public-health, electricity-demand and social-text data on Spark.

Every operator takes and returns DataFrames and works on all series at once;
the series is a key column, never a file name or a Python loop.
"""

import sys

from pyspark import cloudpickle

# Python tasks carry the functions they use, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
