"""Operators for preparing training corpora: near duplicates, language, packing, extraction, mixing, scans, archives."""

import sys

from pyspark import cloudpickle

# functions that tasks run travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
