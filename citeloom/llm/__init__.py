"""Training-data operators: cleaning, filtering, deduplication, mixing and sharding of text corpora.

Nothing else in the library imports this subpackage; ``queries`` registers its
queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
