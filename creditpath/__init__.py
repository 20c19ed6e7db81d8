"""creditpath: multi-touch marketing attribution as Spark DataFrame plans.

Touches -> journeys -> first/last-touch shares; touches -> state transitions
-> transition matrix -> Markov removal effects. Every operator is a function
from DataFrames to DataFrames.
"""

import sys as _sys

try:  # ship our Python functions to executors by value: no install needed there
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass

__version__ = "0.1.0"
