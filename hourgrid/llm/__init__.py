"""Operators for large training-data pipelines, each registered as a query."""

import sys

from pyspark import cloudpickle

# Python-side task code travels with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
