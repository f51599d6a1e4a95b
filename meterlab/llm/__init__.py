"""Operators for training-data pipelines over text, vectors and conversations.

Nothing else in the library imports this package. Functions that run inside
Spark's Python workers are pickled by value, so executors need no copy of it.
"""

import meterlab.llm as _package
from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(_package)
