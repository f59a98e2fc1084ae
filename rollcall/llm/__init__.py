"""Operators and the pipeline of training-data preparation.

Functions that run in tasks travel with their code, so executors need the libraries
they use, but no copy of this package.
"""

from pyspark import cloudpickle

import rollcall

cloudpickle.register_pickle_by_value(rollcall)
