"""Operators for preparing language-model training data; nothing else in the package imports them."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions run by executors travel by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
