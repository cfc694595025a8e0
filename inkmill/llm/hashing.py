"""Deterministic folds and bounded samples shared by the fitted operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = 1 << 30


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id's text modulo ``n``; null ids have no fold."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def sampled(rows: DataFrame, n_rows: int, bound: int, *keys: str) -> DataFrame:
    """About ``bound`` of the ``n_rows`` rows, chosen by a hash of their keys; all, if fewer."""
    if n_rows <= bound:
        return rows
    share = int(_STEPS * bound / n_rows)
    return rows.where(F.pmod(F.xxhash64(*keys, F.lit("sample")), F.lit(_STEPS)) < share)


def small(df: DataFrame, bound: int, n_rows: int | None = None) -> DataFrame:
    """``df`` to be broadcast if it has at most ``bound`` rows, else as it is.

    Either way a join gives the same rows; broadcast, the other side is not shuffled.
    """
    n_rows = df.count() if n_rows is None else n_rows
    return F.broadcast(df) if n_rows <= bound else df
