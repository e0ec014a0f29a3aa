"""Functions that run in Python workers travel with the task, so the package needs no
installation on the executors."""

import sys

from pyspark import cloudpickle


def ship_by_value(module_name: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
