"""rigcast: PySpark-native forecasting of many sensor signals from machine logs.

Composable, lazy DataFrame operators: ingest (``sources``), cleaning and
ordering (``operators.clean``, ``operators.order``), ordered splits, scalers,
lookback/horizon windows, a ridge autoregressive forecaster fitted for all
targets in one distributed pass, error metrics and a champion/challenger
registry. ``plans`` composes them into the batch pipelines.
"""

__version__ = "0.1.0"

# Functions shipped to Python workers (mapInPandas / applyInPandas bodies) are
# pickled by value, so executors need no installed copy of this package.
try:
    import sys as _sys

    import cloudpickle as _cp
except ImportError:  # pragma: no cover
    try:
        from pyspark import cloudpickle as _cp
    except ImportError:
        _cp = None
if _cp is not None:
    _cp.register_pickle_by_value(_sys.modules[__name__])
