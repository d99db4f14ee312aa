"""Operators for training-data pipelines on texts, pages and vectors.

Functions of this package travel to the tasks with their code, so the machines of a cluster need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
