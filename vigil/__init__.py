"""vigil: cohort construction and risk-model validation as Spark DataFrame plans.

Every operator is a pure function ``DataFrame -> DataFrame`` whose column names and
time windows are parameters.  Nothing is collected to the driver; the physical
strategy is left to Catalyst and adaptive query execution.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions that run in Python workers travel whole, so that workers need not import this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from .session import get_session, pin  # noqa: E402,F401
