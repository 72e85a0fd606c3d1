"""Measurement and event analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Executors need not have the package installed: its few Python steps travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
