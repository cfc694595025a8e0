"""Positions in scan order and running totals, without a single-task window over the data.

A running total is computed in two levels: totals per block of consecutive rows (a small
aggregate), running totals over the blocks, and a window inside each block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.staging import stage

# A file table up to this size is broadcast and summed in one small window; a larger one
# is range-partitioned and joined by shuffle.
MAX_SMALL_FILE_TABLE = 100_000


def running_total_by_range(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Inclusive running total of ``value`` for any sortable order columns."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id())
    ranged = stage(ranged, "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (  # one row per range: at most n rows
        ranged.groupBy("_range")
        .agg(F.sum(value).alias("_total"))
        .select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(F.broadcast(starts), "_range")
        .withColumn(out, F.col("_start") + F.sum(value).over(inside))
        .drop("_range", "_start")
    )


def scan_offsets(pieces: DataFrame, n_pieces: int) -> DataFrame:
    """Rows before each piece of a scan: ``_piece``, ``_rows`` -> ``_piece``, ``_offset``.

    ``n_pieces`` is an upper bound known from the file listing. Up to the limit the result
    is broadcast, so that the documents are not shuffled; above it the table is summed by
    ranges and joined by shuffle.
    """
    if n_pieces <= MAX_SMALL_FILE_TABLE:
        upto = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, 0)
        totals = pieces.withColumn("_end", F.sum("_rows").over(upto))
    else:
        totals = running_total_by_range(pieces, ["_piece"], "_rows", "_end")
    offsets = totals.withColumn("_offset", F.col("_end") - F.col("_rows")).drop("_end", "_rows")
    return F.broadcast(offsets) if n_pieces <= MAX_SMALL_FILE_TABLE else offsets


def with_ordinal(df: DataFrame, n_files: int) -> DataFrame:
    """Add the 1-based position over files in name order and rows in file order.

    ``df`` carries ``_piece`` (the file) and ``_row`` (0-based row in it), which are replaced
    by ``ordinal``. Counting rows per file reads Parquet footers only.
    """
    if n_files == 1:
        return df.withColumn("ordinal", F.col("_row") + 1).drop("_piece", "_row")
    counts = df.groupBy("_piece").agg(F.count("*").alias("_rows"))
    return (
        df.join(scan_offsets(counts, n_files), "_piece")
        .withColumn("ordinal", F.col("_offset") + F.col("_row") + 1)
        .drop("_piece", "_row", "_offset")
    )


def block_starts(
    df: DataFrame, value: str, block_rows: int, keys: list[str] | None = None
) -> DataFrame:
    """Total of ``value`` before each block of ``block_rows`` ordinals, per key."""
    keys = keys or []
    block = F.expr(f"(ordinal - 1) div {int(block_rows)}").alias("_block")
    # Without keys one task sums the blocks: fine up to some 10**11 rows.
    before = (
        Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        df.groupBy(*keys, block)
        .agg(F.sum(value).alias("_block_total"))
        .withColumn("_start", F.coalesce(F.sum("_block_total").over(before), F.lit(0)))
    )


def with_running_total(
    df: DataFrame,
    value: str,
    out: str,
    keys: list[str] | None = None,
    inclusive: bool = True,
    block_rows: int = 100_000,
) -> DataFrame:
    """Running total of ``value`` in ``ordinal`` order, per key.

    One shuffle of ``df``, by block of consecutive ordinals; every block has at most
    ``block_rows`` rows per key, so no group depends on the data. The rows come back sorted
    inside their block, which an ordered sink can use as it is.
    """
    keys = keys or []
    starts = block_starts(df, value, block_rows, keys).drop("_block_total")
    end = 0 if inclusive else -1
    inside = (
        Window.partitionBy(*keys, "_block")
        .orderBy("ordinal")
        .rowsBetween(Window.unboundedPreceding, end)
    )
    blocked = df.withColumn("_block", F.expr(f"(ordinal - 1) div {int(block_rows)}"))
    return (
        blocked.join(starts, [*keys, "_block"])
        .withColumn(out, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_block", "_start")
    )
