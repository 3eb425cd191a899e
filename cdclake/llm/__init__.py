"""Operators for preparing language-model training data, each over whole tables.

Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the plan, so that none needs the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
