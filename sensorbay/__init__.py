"""sensorbay: occupancy / environment sensor analytics on Spark DataFrames.

Every operator takes and returns a DataFrame holding *all* sensors at once;
per-sensor work is expressed as windows, grouped aggregates and joins so that
Catalyst plans it and the cluster spreads it.
"""

import sys

__version__ = "0.1.0"

# The few Python functions that run inside tasks (grouped model fits in
# applyInPandas) are shipped by value, so executors need no installed copy of
# this package.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # older cloudpickle: ship the package with --py-files instead
    pass
