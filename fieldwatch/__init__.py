"""fieldwatch: sensor-fleet telemetry and alert analytics on Spark.

Every operator is a function from DataFrames to a DataFrame, written with the
DataFrame / SQL / Structured Streaming API, and usable on batch tables and on
streams alike. See README.md for the operator map.
"""

from fieldwatch.config import Params, DEFAULT_PARAMS, FIXTURE_PARAMS

__all__ = ["Params", "DEFAULT_PARAMS", "FIXTURE_PARAMS"]


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so Python workers (local or on
    a cluster) run pandas functions without the package being installed there."""
    try:
        import sys

        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()
