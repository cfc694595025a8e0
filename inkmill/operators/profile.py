"""Raw-file profiling: rows, non-blank documents, characters, alphabet, a sample."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmill.functions.cleaning import strip
from inkmill.sources import files
from inkmill.staging import stage

# Names tried in this order for the text column.
TEXT_CANDIDATES = [
    "complete_text",
    "text",
    "content",
    "body",
    "document_text",
    "full_text",
    "ocr_text",
    "ocr",
    "clean_text",
    "raw_text",
]
SAMPLE_CHARS = 300
_BLOCK = 32_768  # code points of a bitmap, as Spark's bitmap functions have it
_CODE_POINTS = 34 * _BLOCK
_STEP = 1 << 20  # bytes looked at together


def detect_text_column(schema: T.StructType, forced: str | None = None) -> str:
    """The forced column, else the first known name, else the only string column."""
    strings = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return choose_text_column(schema.names, strings, forced)


def choose_text_column(names: list[str], strings: list[str], forced: str | None) -> str:
    if forced:
        if forced in names:
            return forced
        raise ValueError(f"text column {forced!r} not among {names}")
    known = next((name for name in TEXT_CANDIDATES if name in names), None)
    if known:
        return known
    if len(strings) == 1:
        return strings[0]
    if strings:
        raise ValueError(f"several string columns, name one of {strings}")
    raise ValueError(f"no string column among {names}")


def read_for_profile(
    spark: SparkSession, folder: str, glob: str = "*.parquet", text_column: str | None = None
) -> DataFrame:
    """``file``, ``piece``, ``position`` and ``text`` of every row; only the text column is read.

    A match that is a folder is a table: one file for the profile, of several pieces.
    """
    source = files.read_parquet(spark, folder, glob)
    column = detect_text_column(source.schema, text_column)
    file = F.col("_metadata.file_name")
    if files.has_tables(spark, folder, glob):
        file = files.name_in(spark, folder, F.col("_metadata.file_path"))
    return _profile_input(source, column, file)


def _profile_input(source: DataFrame, column: str, file: Column) -> DataFrame:
    return source.select(
        file.alias("file"),
        F.col("_metadata.file_name").alias("piece"),
        F.col("_metadata.row_index").alias("position"),
        F.col(f"`{column}`").cast("string").alias("text"),
    )


def profile_parts(rows: DataFrame) -> DataFrame:
    """Everything that profiles need, from one scan: one small row per file and block of characters.

    Rows with ``block`` -1 hold a file's counts and first document, the others a bitmap of the
    code points of a block. A task keeps one bitmap of all code points for the file that it reads,
    whatever the length of a text, and sends only blocks that occur.
    """
    text = F.when(strip(F.col("text")) != "", F.col("text"))
    rows = rows.select("file", "piece", "position", F.length(text).alias("n"), text.alias("text"))
    first = "struct<piece:string,position:long,head:string>"
    kind = f"file string, block int, rows long, docs long, chars long, first {first}, bits binary"
    return (
        rows.mapInArrow(_collect_parts, kind)
        .groupBy("file", "block")
        .agg(
            F.sum("rows").alias("rows"),
            F.sum("docs").alias("docs"),
            F.sum("chars").alias("chars"),
            F.min("first").alias("first"),
            F.bitmap_or_agg("bits").alias("bits"),
        )
    )


class _FilePart:
    """What a task has seen of one file."""

    def __init__(self, file: str) -> None:
        self.file = file
        self.rows = self.docs = self.chars = 0
        self.first: tuple[str, int, str] | None = None
        self.seen = np.zeros(_CODE_POINTS, bool)

    def add(self, batch: pa.RecordBatch) -> None:
        """Take some rows of one piece."""
        self.rows += batch.num_rows
        batch = batch.filter(pc.is_valid(batch["n"]))
        if not batch.num_rows:
            return
        self.docs += batch.num_rows
        self.chars += pc.sum(batch["n"]).as_py()
        at = int(np.argmin(batch["position"].to_numpy()))
        place = (batch["piece"][at].as_py(), batch["position"][at].as_py())
        if self.first is None or place < self.first[:2]:
            self.first = (*place, batch["text"][at].as_py()[:SAMPLE_CHARS])
        texts = batch["text"].cast(pa.large_string())
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
        for start in range(0, len(raw), _STEP):
            part = raw[start : start + _STEP]
            self.seen[:128] |= np.bincount(part, minlength=256)[:128] > 0
        # All bytes from 128 up are whole characters, however they lie among the others.
        wide = raw[raw >= 128]
        start = 0
        while start < len(wide):
            end = start + _STEP
            while end < len(wide) and wide[end] & 0xC0 == 0x80:
                end += 1
            codes = wide[start:end].tobytes().decode("utf-8", "replace").encode("utf-32-le")
            self.seen[np.frombuffer(codes, np.uint32)] = True
            start = end

    def result(self) -> pa.RecordBatch:
        blocks = self.seen.reshape(-1, _BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        none = [None] * len(used)
        first = dict(zip(("piece", "position", "head"), self.first)) if self.first else None
        bits = [np.packbits(blocks[i], bitorder="little").tobytes() for i in used]
        head = pa.struct([("piece", pa.string()), ("position", pa.int64()), ("head", pa.string())])
        return pa.RecordBatch.from_pydict(
            {
                "file": pa.array([self.file] * (len(used) + 1), pa.string()),
                "block": pa.array([-1, *used.tolist()], pa.int32()),
                "rows": pa.array([self.rows, *none], pa.int64()),
                "docs": pa.array([self.docs, *none], pa.int64()),
                "chars": pa.array([self.chars, *none], pa.int64()),
                "first": pa.array([first, *none], head),
                "bits": pa.array([None, *bits], pa.binary()),
            }
        )


def _collect_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = None
    for batch in batches:
        names = batch["file"].dictionary_encode()
        codes = names.indices.to_numpy()
        pieces = batch["piece"].dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(pieces) != 0)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(codes)]):
            if start == end:
                continue
            name = names.dictionary[int(codes[start])].as_py()
            if part is None or part.file != name:
                if part is not None:
                    yield part.result()
                part = _FilePart(name)
            part.add(batch.slice(start, end - start))
    if part is not None:
        yield part.result()


def _file_rows(parts: DataFrame) -> DataFrame:
    """One row per file. The sample is the start of its first non-blank document."""
    return (
        parts.groupBy("file")
        .agg(
            _sum("rows").alias("rows"),
            _sum("docs").alias("non_empty_docs"),
            _sum("chars").alias("chars"),
            F.coalesce(F.min("first")["head"], F.lit("")).alias("sample"),
            F.sum(F.bitmap_count("bits")).alias("unique_chars"),
        )
        .select(
            "file",
            "rows",
            "non_empty_docs",
            "chars",
            F.col("chars").alias("char_tokens"),
            F.floor(F.col("chars") / 4).alias("bpe_estimate"),
            "sample",
            "unique_chars",
        )
    )


def _global_row(parts: DataFrame) -> DataFrame:
    """One row over all files; the token estimate comes from the total, not from floors."""
    first = F.struct("file", "first")
    blocks = parts.groupBy("block").agg(
        F.count("*").alias("files"),
        _sum("rows").alias("rows"),
        _sum("docs").alias("docs"),
        _sum("chars").alias("chars"),
        F.min(F.when(F.col("first").isNotNull(), first))["first"]["head"].alias("head"),
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("seen"),
    )
    return blocks.agg(
        _sum(F.when(F.col("block") == -1, F.col("files"))).alias("files"),
        _sum("rows").alias("rows"),
        _sum("docs").alias("non_empty_docs"),
        _sum("chars").alias("chars"),
        F.floor(_sum("chars") / 4).alias("bpe_estimate"),
        F.coalesce(F.max("head"), F.lit("")).alias("sample"),
        _sum("seen").alias("unique_chars"),
    )


def _sum(column: str | Column) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def profile(rows: DataFrame) -> DataFrame:
    """One row per file: counts, sample and the number of distinct characters."""
    return _file_rows(profile_parts(rows))


def profile_files(rows: DataFrame) -> DataFrame:
    return profile(rows).drop("unique_chars")


def unique_chars_per_file(rows: DataFrame) -> DataFrame:
    files = profile(rows).where("unique_chars > 0")
    return files.select("file", "unique_chars")


def global_profile(rows: DataFrame) -> DataFrame:
    return _global_row(profile_parts(rows))


def file_alphabet(rows: DataFrame) -> DataFrame:
    """Distinct (file, character) of the non-blank documents."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                bits = np.frombuffer(batch["bits"][row].as_py(), np.uint8)
                codes = np.flatnonzero(np.unpackbits(bits, bitorder="little")) + batch["block"][row].as_py() * _BLOCK
                names = [batch["file"][row].as_py()] * len(codes)
                yield pa.RecordBatch.from_pydict({"file": names, "character": [chr(c) for c in codes]})

    blocks = profile_parts(rows).where("block >= 0").select("file", "block", "bits")
    return blocks.mapInArrow(spell, "file string, character string")


@dataclass
class FolderProfile:
    """``files``: one row per good file, with its ``text_col``; ``failed``: file and error."""

    files: DataFrame
    total: DataFrame
    processed: int
    failed: DataFrame


def profile_folder(
    spark: SparkSession, folder: str, glob: str = "*.parquet", text_column: str | None = None
) -> FolderProfile:
    """Profile a folder in which single files may be unreadable or lack a text column.

    Tasks look at the footers, file by file; files that share text column and type are then
    read by one job. A file that fails is reported and does not stop the others. A file of
    which fewer rows could be read than its footer lists has failed too, and none of its rows
    count. A file without rows is a good one.
    """
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path")
    )
    footers = listing.repartition(spark.sparkContext.defaultParallelism).mapInArrow(
        _text_columns(text_column),
        "path string, text_col string, type string, n_rows long, error string",
    )
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    footers = stage(footers.select(name, "*"), "footers")
    groups: dict[tuple, list[str]] = {}
    # The paths a reader is given: one string per file, as in Spark's own listing.
    for row in footers.where("error IS NULL").select("path", "text_col", "type").toLocalIterator():
        groups.setdefault((row["text_col"], row["type"]), []).append(row["path"])
    rows = None
    for (column, _), members in groups.items():
        part = spark.read.option("ignoreCorruptFiles", "true").parquet(*sorted(members))
        part = _profile_input(part, column, F.col("_metadata.file_name"))
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        raise FileNotFoundError(f"no readable Parquet file matches {glob!r} in {folder}")
    parts = stage(profile_parts(rows), "profile-parts")
    joined = footers.join(_file_rows(parts), "file", "left")
    seen = F.coalesce("rows", F.lit(0))
    short = F.concat(F.lit("read "), seen.cast("string"), F.lit(" of "), F.col("n_rows").cast("string"), F.lit(" rows"))
    error = F.coalesce("error", F.when(seen != F.col("n_rows"), short))
    joined = joined.withColumn("error", error)
    counts = ["rows", "non_empty_docs", "chars", "char_tokens", "bpe_estimate", "unique_chars"]
    good = joined.where("error IS NULL").select(
        "file",
        "text_col",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("sample", F.lit("")).alias("sample"),
    )
    good = stage(good, "good-files")
    n_good = good.count()  # files without rows have no parts
    failed = stage(joined.where("error IS NOT NULL").select("file", "error"), "failed-files")
    total = _global_row(parts.join(good.select("file"), "file", "left_semi"))
    total = total.withColumn("files", F.lit(n_good).cast("long"))
    return FolderProfile(good, total, n_good, failed)


def _text_columns(forced: str | None):
    """Footer check of a batch of files: text column, type, rows; or the error of a bad file."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                system, inner = files.resolve(path)  # an unknown kind of store is no bad file
                try:
                    with system.open_input_file(inner) as source:
                        footer = pq.ParquetFile(source)
                        schema, n_rows = footer.schema_arrow, footer.metadata.num_rows
                    strings = [
                        f.name
                        for f in schema
                        if pa.types.is_string(f.type) or pa.types.is_large_string(f.type)
                    ]
                    name = choose_text_column(schema.names, strings, forced)
                    found.append((path, name, str(schema.field(name).type), n_rows, None))
                except (pa.ArrowException, OSError, ValueError) as error:
                    # unreadable footer or no clear text column
                    found.append((path, None, None, None, f"{type(error).__name__}: {error}"[:500]))
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string())
            columns = zip(*found) if found else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["path", "text_col", "type", "n_rows", "error"],
            )

    return look
