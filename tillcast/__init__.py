"""tillcast: weekly (store, department) sales analytics on Spark.

Every operator takes and returns DataFrames; nothing is collected inside a
transformation.  See README.md for the map from operators to modules.
"""

from tillcast.config import Params

__all__ = ["Params"]
