"""Text to next-word model, as Spark jobs over DataFrames."""

import sys

from pyspark import cloudpickle

from wordloom.config import Limits, ModelConfig

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Limits", "ModelConfig"]
