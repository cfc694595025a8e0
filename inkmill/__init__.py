"""Text-corpus preparation, byte-level BPE and token datasets as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

from inkmill.config import ColumnMap, CorpusConfig

# Functions sent to executors carry their code, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ColumnMap", "CorpusConfig"]
