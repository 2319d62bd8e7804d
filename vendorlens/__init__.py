"""vendorlens: procurement and vendor-margin analytics as Spark DataFrame operators.

Every operator is a pure function ``(DataFrame, ..., params) -> DataFrame`` built
from the public PySpark API, so Catalyst plans it and AQE re-plans it at runtime.

Sub-packages
------------
sources    base-table derivation, CSV ingest/export, catalog helpers (S*)
functions  column-expression guards (safe division, SQLite casts, ranks, buckets)
operators  summary tables (T*), data quality (Q*), KPIs (A*), distributions (D*),
           resampling inference (H*)
plans      the end-to-end table build and the registry of checked queries
streaming  incremental ingest of arriving CSV drops into the base tables
"""

import sys as _sys

# Python code that runs inside tasks (pandas UDFs, applyInPandas) is shipped with the
# task by value, so executors need no copy of this package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pickler: workers import the package instead
    pass

from vendorlens.session import get_spark, checkpoint_dir  # noqa: E402,F401

__all__ = ["get_spark", "checkpoint_dir"]
