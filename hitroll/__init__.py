"""hitroll: per-file annotation and summary on Spark.

Scan whole structure files, run a caller-supplied command or a labelled vector search over each,
read the resulting hit tables with their JSON metadata, reject malformed structures as a unit
while keeping the reasons, and reduce the rest to per-structure scores, per-dataset mean and
population standard deviation, and counts per classification code.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value into Spark task closures, so Python workers
    need not have the package installed or on their path (they run ``mapInPandas`` stages)."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - pyspark is a dependency
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
