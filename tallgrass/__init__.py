"""PySpark operators for sensor readings, orders, graphs and labelled vectors."""

import sys

from pyspark import cloudpickle

from tallgrass.session import build_session, configure, load_table

# Helper functions that run in Python workers travel with the task, so the package does not
# have to be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "configure", "load_table"]
