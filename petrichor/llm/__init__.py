"""Operators for preparing the training text of language models."""

from pyspark import cloudpickle

import petrichor

# What runs inside tasks travels with them, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(petrichor)
