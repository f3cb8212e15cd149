"""emberline: weather-risk analytics as Spark DataFrame jobs.

Generates or reads observation tables, derives risk scores, rule labels and
coordinates, trains a regularised multi-class logistic regression, scores
tables into label/probability columns, evaluates the model and answers the
read-side questions over stored predictions.
"""

import sys as _sys

__version__ = "0.1.0"

# The few functions that run inside Python workers (Arrow batch passes of the
# trainer and the AUC) are shipped by value, so executors need neither this
# package installed nor the driver's working directory on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: fall back to --py-files
    pass
