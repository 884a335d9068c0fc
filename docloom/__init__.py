"""Document-processing operators on Spark DataFrames.

Every operator takes and returns DataFrames or Columns, so Catalyst sees one
declarative plan.  Python runs inside tasks in two places only: opening archive
containers and calling the pluggable parser.
"""

import sys

from pyspark import cloudpickle

from docloom.limits import Limits

# What runs inside tasks travels by value, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Limits"]
__version__ = "0.1.0"
