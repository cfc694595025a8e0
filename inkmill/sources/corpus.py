"""Corpus input: Parquet files and JSON lines, with the position of every document."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.config import ColumnMap
from inkmill.functions.cleaning import strip
from inkmill.operators.ordering import scan_offsets, with_ordinal
from inkmill.operators.selection import budget_cut
from inkmill.sources.files import read_parquet
from inkmill.staging import spread, stage


def read_corpus(
    spark: SparkSession, folder: str, glob: str = "*.parquet", columns: ColumnMap = ColumnMap()
) -> DataFrame:
    """Documents of the Parquet files in ``folder`` that match ``glob``.

    A match that is a folder is a table; all its files are read. Reads only the mapped columns.
    Returns ordinal, file_id, title, author, date, text; the ordinal counts all rows, files in
    name order. A text column that is not a string counts as missing text.
    """
    return _documents(_load_parquet(spark, folder, glob), columns)


def corpus_files(spark: SparkSession, folder: str, glob: str = "*.parquet") -> list[str]:
    """Paths of the files that ``read_corpus`` reads, in the order of their ordinals."""
    paths = [unquote(path) for path in _load_parquet(spark, folder, glob).inputFiles()]
    return sorted(paths, key=lambda path: (path.rsplit("/", 1)[-1].encode(), path.encode()))


def read_corpus_files(
    spark: SparkSession, paths: list[str], columns: ColumnMap = ColumnMap()
) -> DataFrame:
    """Like ``read_corpus`` for some of its files; ordinals count from the first of them."""
    return _documents(spark.read.parquet(*paths), columns)


def _documents(source: DataFrame, columns: ColumnMap) -> DataFrame:
    def mapped(name: str | None, required: bool = False) -> Column:
        if name is None:
            return F.lit(None).cast("string")
        if required and not isinstance(source.schema[name].dataType, T.StringType):
            return F.lit(None).cast("string")
        return F.col(f"`{name}`").cast("string")

    docs = source.select(
        F.struct("_metadata.file_name", "_metadata.file_path").alias("_piece"),
        F.col("_metadata.row_index").alias("_row"),
        mapped(columns.file_id).alias("file_id"),
        mapped(columns.title).alias("title"),
        mapped(columns.author).alias("author"),
        mapped(columns.date).alias("date"),
        mapped(columns.text, required=True).alias("text"),
    )
    docs = with_ordinal(docs, len(source.inputFiles()))
    docs = docs.select("ordinal", "file_id", "title", "author", "date", "text")
    return spread(docs, "ordinal", scan=source)


def _load_parquet(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    message = f"no Parquet files match {glob!r} in {folder}"
    try:
        source = read_parquet(spark, folder, glob)
    except AnalysisException as error:
        if "UNABLE_TO_INFER_SCHEMA" in str(error) or "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(message) from error
        raise
    if not source.inputFiles():
        raise FileNotFoundError(message)
    return source


def read_jsonl_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank JSON lines: ``ordinal`` (position among all lines) and ``value``.

    A text split is read by one task in order, so inside a split
    ``monotonically_increasing_id`` gives the row order; the split itself is known by file
    and start. The files are scanned once, into a staged table; the small table of splits is
    counted there and joined back, so lines and counts are of the same splits.
    """
    source = spark.read.text(path)
    # Every split fills a scan partition or is the rest of a file.
    n_splits = len(source.inputFiles()) + source.rdd.getNumPartitions()
    lines = source.select(
        F.struct(
            "_metadata.file_name", "_metadata.file_path", "_metadata.file_block_start"
        ).alias("_piece"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )
    lines = stage(lines, "lines")
    splits = lines.groupBy("_piece").agg(F.count("*").alias("_rows"), F.min("_id").alias("_first"))
    return (
        lines.join(scan_offsets(splits, n_splits), "_piece")
        .select((F.col("_offset") + F.col("_id") - F.col("_first") + 1).alias("ordinal"), "value")
        .where(strip(F.col("value")) != "")
    )


def read_split_texts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``ordinal``, ``split`` and ``text`` of the JSON lines of several splits, named with their paths.

    Ordinals count within a split. Records without a text string are kept, with a null text.
    """
    parts = [
        _jsonl_records(spark, path).withColumn("split", F.lit(split)) for split, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts).select("ordinal", "split", "text")


def read_jsonl_texts(spark: SparkSession, path: str) -> DataFrame:
    """``ordinal`` and ``text`` of the lines whose ``text`` is a non-empty JSON string.

    Lines with a missing, empty or non-string text are dropped; a malformed line raises.
    """
    return _jsonl_records(spark, path).where(F.col("text") != "")


def _jsonl_records(spark: SparkSession, path: str) -> DataFrame:
    record = read_jsonl_lines(spark, path).withColumn("_text", F.expr(
        "variant_get(parse_json(value), '$.text', 'variant')"
    ))
    is_string = F.schema_of_variant("_text") == "STRING"
    text = F.when(is_string, F.variant_get("_text", "$", "string"))
    return record.select("ordinal", text.alias("text"))


def count_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row: the number of non-blank lines."""
    lines = spark.read.text(path).where(strip(F.col("value")) != "")
    return lines.agg(F.count("*").alias("docs"))


def limit_docs(docs: DataFrame, n: int) -> DataFrame:
    """The first ``n`` documents with a non-empty text in scan order.

    Only ordinals are ranked, block by block; texts stay where they are, cut by the ordinal of
    the n-th valid one.
    """
    valid = docs.where(F.col("text") != "")
    cut = budget_cut(valid.select("ordinal", F.lit(1).alias("chars")), n)
    if n <= 0:
        return valid.limit(0)
    return valid if cut is None else valid.where(F.col("ordinal") <= cut)


def corpus_size(docs: DataFrame) -> DataFrame:
    """One row: documents with text and their characters."""
    valid = docs.where(F.col("text") != "")
    return valid.agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("characters"),
    )
