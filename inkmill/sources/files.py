"""Small files through Arrow file systems, so that paths may be local or shared."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Hadoop's names of stores that Arrow knows by another one.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path. ``dbfs:/x`` is the mounted folder ``/dbfs/x``."""
    found = re.match(r"^([a-zA-Z][a-zA-Z0-9+.-]*):(/.*)$", path)
    if not found:
        return fs.LocalFileSystem(), path
    scheme, rest = found[1].lower(), found[2]
    if scheme == "dbfs":
        return fs.LocalFileSystem(), "/dbfs/" + rest.lstrip("/")
    if scheme == "file":
        rest = "//" + re.sub(r"^//[^/]*(?=/)", "", rest)
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme; without one it lies in the session's default file system.

    To be called on the driver: to a task, a bare path would be a folder of its own machine.
    """
    if re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", path):
        return path
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(hadoop).toString()


def has_tables(spark: SparkSession, folder: str, glob: str) -> bool:
    """Whether a match of ``glob`` in ``folder`` is itself a folder named ``*.parquet``: a table of several files."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(folder, glob)
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(pattern) or []
    return any(f.isDirectory() and f.getPath().getName().endswith(".parquet") for f in found)


def read_parquet(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """Parquet files of ``folder`` that match ``glob``, and all files of the tables that do."""
    if has_tables(spark, folder, glob):
        return spark.read.parquet(f"{folder.rstrip('/')}/{glob}")
    return spark.read.option("pathGlobFilter", glob).parquet(folder)


def name_in(spark: SparkSession, folder: str, path: Column) -> Column:
    """Name of the file or table right in ``folder`` that the URL-encoded ``path`` belongs to."""
    depth = spark._jvm.org.apache.hadoop.fs.Path(qualified(spark, folder)).depth()
    inner = F.regexp_replace(path, "^[^/]*:(//[^/]*)?/", "")
    name = F.element_at(F.split(inner, "/"), depth + 1)
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def write_bytes(path: str, content: bytes) -> None:
    system, inner = resolve(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(inner) as out:
        out.write(content)


def read_bytes(path: str) -> bytes:
    system, inner = resolve(path)
    with system.open_input_stream(inner) as source:
        return source.read()


def exists(path: str) -> bool:
    system, inner = resolve(path)
    return system.get_file_info(inner).type != fs.FileType.NotFound


def names(folder: str) -> list[str]:
    """Names of the files right below ``folder``."""
    system, inner = resolve(folder)
    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return [info.base_name for info in found if info.type == fs.FileType.File]


def publish(folder: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder beside ``folder``, then give it that name.

    Readers see the whole folder or none; a failed writer leaves nothing. File systems rename a
    folder in one step; object stores copy file by file.
    """
    folder = folder.rstrip("/")
    if exists(folder):
        raise FileExistsError(folder)
    draft = f"{folder}.draft-{uuid.uuid4().hex}"
    system, inner = resolve(draft)
    try:
        write(draft)
        system.move(inner, resolve(folder)[1])
    except BaseException:
        if exists(draft):
            system.delete_dir(inner)
        raise


def delete(paths: Iterable[str]) -> None:
    for path in paths:
        if exists(path):
            system, inner = resolve(path)
            system.delete_file(inner)
