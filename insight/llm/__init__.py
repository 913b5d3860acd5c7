"""Training-data operators: scoring, filtering, deduplication, mixing.

Nothing else in the library imports this subpackage.  Its queries live in
:mod:`insight.llm.queries`.
"""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the plan, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
