"""tallyglass: disclosure analytics as PySpark DataFrame jobs.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns; nothing inside the operators collects data on the driver.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# The few Python functions that run in tasks travel with the job, so executors
# need no copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
