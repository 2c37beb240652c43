"""A similarity data mart on Spark: land, conform, fingerprint, score, serve, gate."""

import sys

from pyspark import cloudpickle

from kinmart.config import Settings

# Functions that run inside tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Settings"]
