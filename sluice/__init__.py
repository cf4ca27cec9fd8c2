"""sluice: a PySpark-native ingestion, history and data-preparation engine."""

import sys

try:
    from pyspark import cloudpickle
except ImportError:  # configuration, manifests and decoding work without Spark
    pass
else:
    # Functions that run on executors travel with their code, so executors need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
_PUBLIC = ("run_job", "run_table", "run_bronze_job")


def __getattr__(name: str):
    """The jobs, imported when they are asked for."""
    if name in _PUBLIC:
        from importlib import import_module

        return getattr(import_module("sluice.plans.jobs"), name)
    raise AttributeError(name)
