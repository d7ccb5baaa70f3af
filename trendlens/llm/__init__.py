"""Operators for preparing language-model training data.

Nothing outside this folder, its tests and ``corpus_pipeline.py`` imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to Python workers by value, so executors need
# no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
