"""Vital-sign readings on Spark: parse, flag, alert, store, query; batch and stream."""

import sys as _sys

try:  # ship our own classes and functions to Python workers by value, so the
    # package works on executors where it is not installed (e.g. --py-files not set)
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - pickling by reference still works when installed
    pass
