"""News feed and web-page analytics on Spark.

Sub-packages: ``sources`` (readers, sinks), ``functions`` (column expressions),
``operators`` (DataFrame to DataFrame), ``plans`` (whole jobs and their checks),
``streaming`` (stream forms of the batch operators).
"""

import sys

from pyspark import cloudpickle

# Executors need not have the package installed: its functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
