"""tablelearn: statistical learning on Spark tables.

Fitting is a set of distributed DataFrame aggregations that yields a small
model table; scoring is a projection (or a join against that model) over any
table; evaluation is an aggregation over scored rows.
"""

import sys as _sys

__version__ = "0.1.0"

# Arrow / pandas tasks reference helpers of this package; pickle them by value
# so executors need no installed copy of the package (nothing to ship with
# --py-files, and the driver's sys.path does not have to match the workers').
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass
