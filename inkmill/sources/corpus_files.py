"""Output of a corpus build as JSON lines, and the one-object summary files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkmill.plans.corpus_build import CorpusBuild

# Characters per output file of the train and validation sets, and about as many per report.
CHARS_PER_FILE = 256_000_000
REPORT_ROW_CHARS = 1_000
# Blocks of consecutive ordinals that share a file; their table is broadcast.
MAX_BLOCKS = 1_000_000


def in_scan_order(df: DataFrame, sizes: DataFrame, chars_per_file: int) -> DataFrame:
    """Lay rows out so that file names, then lines, follow the ordinal.

    ``sizes`` (ordinal, chars) are the rows that get written. A block of consecutive ordinals
    (one document each, up to a million) goes to the file in which the characters before it
    fall, so files are about equally large wherever the rows lie; no sampling pass over the
    text, and one shuffle of kept documents only.
    """
    whole = sizes.agg(F.max("ordinal").alias("last"), F.sum("chars").alias("chars")).first()
    n_files = max(1, -(-(whole["chars"] or 0) // chars_per_file))
    step = max(1, -(-(whole["last"] or 1) // MAX_BLOCKS))
    block = F.expr(f"(ordinal - 1) div {step}")
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy(block.alias("_block")).agg(F.sum("chars").alias("_chars"))
    start = F.coalesce(F.sum("_chars").over(before), F.lit(0))
    number = F.least(F.floor(start / chars_per_file), F.lit(n_files - 1)).cast("int")
    files = totals.select("_block", number.alias("_file"))
    placed = df.withColumn("_block", block).join(F.broadcast(files), "_block")
    return placed.repartitionById(n_files, "_file").drop("_block", "_file")


def write_corpus(build: CorpusBuild, folder: str, write_rejected: bool = False) -> None:
    """``corpus/split=train``, ``corpus/split=val``, ``kept_report``, ``summary`` and, if
    asked for, ``rejected_report`` below ``folder``; all JSON lines in scan order."""
    folder = folder.rstrip("/")
    sizes = build.kept_identity.select("ordinal", "chars")
    ordered = in_scan_order(build.corpus, sizes, CHARS_PER_FILE).sortWithinPartitions("split", "ordinal")
    ordered.drop("ordinal").write.partitionBy("split").json(
        f"{folder}/corpus", mode="error", ignoreNullFields=False
    )
    reports = {"kept_report": build.kept_report}
    if write_rejected:
        reports["rejected_report"] = build.rejected_report
    for name, report in reports.items():
        sizes = report.select("ordinal", F.lit(REPORT_ROW_CHARS).alias("chars"))
        ordered = in_scan_order(report, sizes, CHARS_PER_FILE).sortWithinPartitions("ordinal")
        ordered.drop("ordinal").write.json(f"{folder}/{name}", ignoreNullFields=False)
    write_object(build.summary, f"{folder}/summary")


def write_object(row: DataFrame, path: str) -> None:
    """A one-row DataFrame as one JSON object in one file."""
    row.coalesce(1).write.json(path, ignoreNullFields=False)
