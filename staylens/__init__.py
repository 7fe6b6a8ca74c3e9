"""staylens: short-term-rental market analytics as Spark DataFrame jobs.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column`` for the scalar helpers in :mod:`staylens.functions`).  Nothing is
collected to the driver except small, size-bounded aggregates (tier
thresholds, regression moments, icon lists).
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Functions of this package that run in Python workers (grouped maps,
    partition maps) are pickled with their code, so executors need no copy of
    the package installed or on their path."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # older pyspark: rely on the package being importable on workers
        pass


_ship_by_value()

