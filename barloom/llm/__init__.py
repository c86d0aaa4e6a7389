"""Operators that prepare training data for language models. Nothing else imports this folder."""

import sys

from pyspark import cloudpickle

# Task code travels with its tasks; Python workers need not have this folder on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
