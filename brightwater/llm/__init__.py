"""Operators for preparing training data at corpus scale.

Nothing else in the library imports this package. Its functions are pickled
by value, so executors need not have it installed.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
