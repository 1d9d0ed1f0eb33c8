"""Training-data operators: deduplication, filtering, extraction, scoring and packing of text at scale.

Nothing outside this subpackage imports it; ``queries.py`` holds its registered queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks are shipped by value: executors need this package's dependencies, not the package itself.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
