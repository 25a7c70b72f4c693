"""Operators for preparing training text: one module each, read by nothing else in the library.

``queries`` registers one query per operator; ``corpus_pipeline.py`` at the top of the
repository strings five of them together.
"""

import sys

from pyspark import cloudpickle

# functions of this package travel to the workers by value, so executors need no copy of it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
