"""Operators for preparing training text at scale.

Nothing outside this folder imports it. Functions that run on executors are
pickled with their code, so a cluster needs no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
