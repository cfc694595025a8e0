"""Written intermediate tables in the cluster's shared checkpoint folder.

Results that several outputs read are written once as Parquet. Unlike a cached or
locally checkpointed table, they survive the loss of any executor, and later readers
get column pruning (the text column of a staged corpus is only read by the job that
writes it out).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 500


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves a local session. On a cluster each executor
    would write to its own disk, so there an unset folder is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder; master is {master!r}")
        folder = tempfile.mkdtemp(prefix="inkmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/inkmill/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of at most ``BATCH_ROWS`` rows; texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def spread(df: DataFrame, *keys: str, scan: DataFrame | None = None) -> DataFrame:
    """Use all cores when the input has fewer scan splits than the session has slots.

    ``scan`` is the plain scan below ``df`` if ``df`` is more than that; only its splits are
    counted, nothing runs. A big input always has more splits than slots, so there this adds
    no shuffle.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if (df if scan is None else scan).rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots, *keys)
