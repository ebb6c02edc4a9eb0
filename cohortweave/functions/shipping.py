"""Functions that run inside tasks."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def by_value(module: str) -> None:
    """Send the functions of a module to executors by value, so that they need no copy of the library."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
