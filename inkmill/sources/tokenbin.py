"""Flat binary token streams as a Spark data source (``format("tokenbin")``).

A written stream is a folder of shards and a manifest. Each shard holds a run of adjacent
documents as little-endian integers; shards in manifest order, laid end to end, are the
whole stream. Shards have unique names and count only once the manifest lists them; those of
lost or retried tasks are deleted at the end of the job.

``write_stream`` lays a stream out as shards of equal size, ``read_windows`` reads nothing but
the bytes of the windows asked for. Both place a path without a scheme in the session's default
file system; the plain source takes it as a mounted folder, so on a cluster give it a full URI.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from inkmill.sources import files

MANIFEST = "manifest.json"
# Integer types a stream may be stored in.
DTYPES = {"uint16": "<u2", "uint32": "<u4", "int32": "<i4", "int64": "<i8"}
WIDE = ("uint32", "int64")
TOKENS_PER_ROW = 65_536
ROWS_PER_PARTITION = 256
SHARD_TOKENS = 268_435_456
# Tokens that a task writes, if shards are smaller; a larger shard has a task of its own.
TASK_TOKENS = 4_194_304
# Ids of windows that a task holds at a time.
WINDOW_IDS = 4_194_304


def numpy_dtype(name: str) -> np.dtype:
    if name not in DTYPES:
        raise ValueError(f"unsupported token dtype {name!r}")
    return np.dtype(DTYPES[name])


def listed(path: str) -> dict | None:
    """The manifest of the stream in ``path``, or None."""
    manifest = f"{path}/{MANIFEST}"
    return json.loads(files.read_bytes(manifest)) if files.exists(manifest) else None


class TokenBinSource(DataSource):
    """Read ``start_offset long, ids array<int>``; write the same columns.

    Options: ``dtype`` (needed to write, and to read a bare ``.bin`` file); ``from`` and ``until``
    (read only the tokens of that range, the last one excluded); ``shard_tokens`` (start a new
    shard at each multiple).
    """

    @classmethod
    def name(cls) -> str:
        return "tokenbin"

    def schema(self) -> str:
        dtype = self.options.get("dtype", "")
        if not dtype:
            dtype = (listed(self.options["path"].rstrip("/")) or {}).get("dtype")
        return f"start_offset bigint, ids array<{'bigint' if dtype in WIDE else 'int'}>"

    def reader(self, schema) -> DataSourceReader:
        return TokenBinReader(dict(self.options), schema)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return TokenBinWriter(dict(self.options), overwrite)


@dataclass
class Piece(InputPartition):
    file: str
    dtype: str
    skip: int  # tokens before the piece in its file
    count: int
    offset: int  # of the first token in the whole stream


class TokenBinReader(DataSourceReader):
    def __init__(self, options: dict, schema):
        self.path = options["path"].rstrip("/")
        self.options = options
        self.wide = "bigint" in schema["ids"].dataType.simpleString()
        self.low = int(options.get("from", 0))
        self.high = int(options.get("until", 2**63 - 1))

    def _shards(self):
        manifest = listed(self.path)
        if manifest is not None:
            for shard in manifest["shards"]:
                yield f"{self.path}/{shard['file']}", manifest["dtype"], shard["offset"], shard["tokens"]
            return
        dtype = numpy_dtype(self.options.get("dtype", ""))
        system, inner = files.resolve(self.path)
        yield self.path, self.options["dtype"], 0, system.get_file_info(inner).size // dtype.itemsize

    def partitions(self):
        step = TOKENS_PER_ROW * ROWS_PER_PARTITION
        return [
            Piece(file, dtype, skip, min(step, last - skip), offset + skip)
            for file, dtype, offset, tokens in self._shards()
            for last in [min(tokens, self.high - offset)]
            for skip in range(max(0, self.low - offset), last, step)
        ] or [Piece("", "uint16", 0, 0, 0)]

    def read(self, partition: Piece):
        if not partition.count:
            return
        dtype = numpy_dtype(partition.dtype)
        target = (np.int64, pa.int64()) if self.wide else (np.int32, pa.int32())
        system, inner = files.resolve(partition.file)
        with system.open_input_file(inner) as source:
            source.seek(partition.skip * dtype.itemsize)
            for done in range(0, partition.count, TOKENS_PER_ROW):
                take = min(TOKENS_PER_ROW, partition.count - done)
                ids = np.frombuffer(source.read(take * dtype.itemsize), dtype).astype(target[0])
                row = pa.ListArray.from_arrays(pa.array([0, take], pa.int32()), pa.array(ids, target[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition.offset + done], pa.int64()), row],
                    names=["start_offset", "ids"],
                )


@dataclass
class Shards(WriterCommitMessage):
    shards: list[dict]


class TokenBinWriter(DataSourceArrowWriter):
    """A folder holds one stream: a second append raises, overwriting replaces the first."""

    def __init__(self, options: dict, overwrite: bool = False):
        self.path = options["path"].rstrip("/")
        self.dtype_name = options.get("dtype", "")
        self.dtype = numpy_dtype(self.dtype_name)
        self.shard_tokens = int(options.get("shard_tokens", 0)) or 2**63
        self.job = uuid.uuid4().hex
        manifest = listed(self.path)
        if manifest is not None and not overwrite:
            raise FileExistsError(f"{self.path} already holds a token stream")
        self.old = [s["file"] for s in manifest["shards"]] if manifest else []

    def write(self, iterator) -> Shards:
        """Append ids to a shard as long as they start where the last ones ended, up to its size."""
        system, inner = files.resolve(self.path)
        system.create_dir(inner, recursive=True)
        limits = np.iinfo(self.dtype)
        shards, out, end = [], None, None
        for batch in iterator:
            starts = batch.column("start_offset").to_pylist()
            lists = batch.column("ids")
            values, bounds = lists.flatten().to_numpy(), np.asarray(lists.offsets)
            if len(values) and not (limits.min <= values.min() and values.max() <= limits.max):
                raise ValueError(f"token id does not fit {self.dtype_name}")
            bounds = bounds - bounds[0]
            for start, low, high in zip(starts, bounds.tolist(), bounds[1:].tolist()):
                while low < high:
                    if start != end or start % self.shard_tokens == 0:
                        if out is not None:
                            out.close()
                        name = f"shard-{start:020d}-{self.job}-{uuid.uuid4().hex}.bin"
                        out = system.open_output_stream(f"{inner}/{name}")
                        shards.append({"file": name, "offset": start, "tokens": 0})
                    take = min(high - low, self.shard_tokens - start % self.shard_tokens)
                    out.write(values[low : low + take].astype(self.dtype).tobytes())
                    shards[-1]["tokens"] += take
                    start, low = start + take, low + take
                    end = start
        if out is not None:
            out.close()
        return Shards(shards)

    def commit(self, messages) -> None:
        shards = sorted((s for m in messages if m for s in m.shards), key=lambda s: s["offset"])
        end = 0
        for shard in shards:
            if shard["offset"] != end:
                raise ValueError(f"token stream has a gap or overlap at {end}")
            end += shard["tokens"]
        manifest = {"dtype": self.dtype_name, "tokens": end, "shards": shards}
        files.write_bytes(f"{self.path}/{MANIFEST}", json.dumps(manifest, indent=2).encode())
        files.delete(f"{self.path}/{name}" for name in self.old)
        self._sweep({shard["file"] for shard in shards})

    def abort(self, messages) -> None:
        self._sweep(set())

    def _sweep(self, kept: set[str]) -> None:
        """Delete this job's other shards; failed attempts name theirs in no message."""
        mine = (name for name in files.names(self.path) if f"-{self.job}-" in name)
        files.delete(f"{self.path}/{name}" for name in mine if name not in kept)


def write_stream(
    placed: DataFrame, path: str, dtype: str, n_tokens: int, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Write ``start_offset``, ``ids`` of a stream of ``n_tokens`` as shards of ``shard_tokens``.

    A task writes one run of adjacent shards, as many as make up ``TASK_TOKENS`` or else a single
    one, so tasks grow with the tokens and not with the number of shards. Documents are cut at the
    borders of runs, sorted in their task, on disk if need be, and cut there at the borders of shards:
    there are ceil(n_tokens / shard_tokens) shards, whatever the layout before.
    """
    spark = placed.sparkSession
    register(spark)
    run_tokens = shard_tokens * max(1, TASK_TOKENS // shard_tokens)
    begin, size, width = F.col("start_offset"), F.size("ids"), F.lit(int(run_tokens))

    def part(run):
        low = F.greatest(begin, run * width)
        high = F.least(begin + size, (run + 1) * width)
        cut = F.slice("ids", (low - begin + 1).cast("int"), (high - low).cast("int"))
        ids = F.when(high - low == size, F.col("ids")).otherwise(cut)
        return F.struct(run.cast("int").alias("run"), low.alias("start_offset"), ids.alias("ids"))

    runs = F.sequence(F.floor(begin / width), F.floor((begin + size - 1) / width))
    parts = placed.where(size > 0).select(F.explode(F.transform(runs, part)).alias("p")).select("p.*")
    laid = parts.repartitionById(max(1, -(-n_tokens // run_tokens)), "run")
    out = laid.sortWithinPartitions("start_offset").select("start_offset", "ids").write
    out = out.format("tokenbin").option("dtype", dtype).option("shard_tokens", shard_tokens)
    out.mode("append").save(files.qualified(spark, path))


def window_ids(
    starts: np.ndarray, length: int, path: str, dtype: np.dtype, shards: list[tuple[str, int, int]]
) -> np.ndarray:
    """One row of ``length`` ids per start; reads these ids only. Fast for ascending starts."""
    offsets = np.array([offset for _, offset, _ in shards])
    out = np.empty((len(starts), length), dtype)
    opened, source = None, None
    for row, start in zip(out, starts.tolist()):
        done = 0
        while done < length:
            at = int(np.searchsorted(offsets, start + done, "right")) - 1
            name, offset, tokens = shards[at] if at >= 0 else ("", 0, 0)
            skip = start + done - offset
            take = min(length - done, tokens - skip)
            if take <= 0:
                raise ValueError(f"the stream has no {length} tokens from {start} on")
            if opened != name:
                if source is not None:
                    source.close()
                system, inner = files.resolve(f"{path}/{name}")
                opened, source = name, system.open_input_file(inner)
            source.seek(skip * dtype.itemsize)
            row[done : done + take] = np.frombuffer(source.read(take * dtype.itemsize), dtype)
            done += take
    if source is not None:
        source.close()
    return out


def read_windows(starts: DataFrame, path: str, block_size: int) -> DataFrame:
    """Windows ``x`` and targets ``y`` (shifted by one) of the stream written to ``path``.

    ``starts`` has ``window_id`` and ``start``. No token is scanned or shuffled: each task reads
    the ``block_size + 1`` ids of its own windows, in the order of their starts, so what is read
    grows with the windows, not with the stream.
    """
    path = files.qualified(starts.sparkSession, path).rstrip("/")
    manifest = listed(path)
    if manifest is None:
        raise FileNotFoundError(f"{path} holds no token stream")
    shards = [(s["file"], s["offset"], s["tokens"]) for s in manifest["shards"]]
    stored = numpy_dtype(manifest["dtype"])
    wide = manifest["dtype"] in WIDE
    target = pa.int64() if wide else pa.int32()

    def arrays(ids: np.ndarray) -> pa.ListArray:
        bounds = np.arange(len(ids) + 1, dtype=np.int32) * block_size
        flat = pa.array(ids.ravel().astype(target.to_pandas_dtype()))
        return pa.ListArray.from_arrays(pa.array(bounds), flat)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, WINDOW_IDS // (block_size + 1))
        for batch in batches:
            for low in range(0, batch.num_rows, step):
                some = batch.slice(low, step)
                wanted = some.column("start").to_numpy()
                ids = window_ids(wanted, block_size + 1, path, stored, shards)
                columns = [some.column("window_id"), some.column("start"), arrays(ids[:, :-1]), arrays(ids[:, 1:])]
                yield pa.RecordBatch.from_arrays(columns, names=["window_id", "start", "x", "y"])

    kind = "array<bigint>" if wide else "array<int>"
    wanted = starts.select(F.col("window_id").cast("long"), F.col("start").cast("long"))
    wanted = wanted.sortWithinPartitions("start")
    return wanted.mapInArrow(read, f"window_id bigint, start bigint, x {kind}, y {kind}")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TokenBinSource)
