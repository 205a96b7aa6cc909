"""Operators that prepare text corpora for language-model training. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the tasks with their code, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
