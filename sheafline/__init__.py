"""Document analytics on Spark DataFrames.

Sections, chunks, vectors, document maps and batch question answering, each a
``DataFrame -> DataFrame`` function that runs on the executors.
"""

import sys

from pyspark import cloudpickle

# Send the functions that run in Python workers by value, so that executors need
# nothing installed beyond PySpark, numpy and pyarrow.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
