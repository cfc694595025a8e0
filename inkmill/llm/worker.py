"""Memory of Python workers: what they keep between tasks, and how much they get at once."""

from __future__ import annotations

import sys
import types

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_ROWS = 500


def worker_state(name: str) -> dict:
    """A dictionary that lives as long as this worker process, so only caches belong here.

    Empty in a new worker. A worker keeps the state of one name at a time; under another name it
    also gives back what Arrow holds for batches to come.
    """
    home = sys.modules.setdefault("_worker_state", types.ModuleType("_worker_state"))
    state = home.__dict__.get("state")
    if state is None or home.__dict__.get("name") != name:
        state = {}
        home.__dict__.update(name=name, state=state)
        pa.default_memory_pool().release_unused()
    return state


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of at most ``BATCH_ROWS`` rows; texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


class RecentCache:
    """A dictionary of two generations: what was used lately outlives the rest."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def find(self, key):
        """For a key that is not in ``young``: its value in ``old``, which becomes young."""
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value
