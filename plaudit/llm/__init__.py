"""Training-data operators: archives, de-duplication, PII, decontamination,
quality, mixing and training-order output. Nothing else in the library
imports this subpackage; ``queries.py`` holds its registered queries."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the Python workers by value, so the
# executors need the public libraries only, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
