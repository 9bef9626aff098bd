"""Operators for preparing training text. Nothing else in the library imports this subpackage."""

from pyspark import cloudpickle as _cloudpickle

import ledgerloom.llm as _self

# Task functions travel with their code, so executors need not have this package installed.
_cloudpickle.register_pickle_by_value(_self)
