"""WARC archives of pages, written by Spark's text sink and read back by boundary chains.

Writing: one uncompressed record per page, ended by the blank lines that a WARC needs. Of pages
with equal payloads of at least ``revisit_bytes`` bytes the one with the smallest id is a
response, the others are revisits of it without payload.

Reading: an archive is split at every occurrence of the version line, so tasks may begin
anywhere. Each occurrence is a candidate record; its headers give the offset of its successor.
Pointer jumping from the start of the file doubles the reach in every round and keeps only
what the chain visits, so a version line inside a payload, even with sound headers after it,
is no record. Payloads that hold version lines are put together from their parts.

Defined cases: null html is an empty payload; a null url is left out; a line break in a url is
percent-encoded. Rows without page_id are responses with a null id. Rows that agree in page_id
and payload get the same record type. A chain ends where the next version line is missing;
what lies behind is not read. An empty table gives no records. Other columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkmill.llm.worker import small_batches
from inkmill.staging import stage

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
RECORDS_PER_FILE = 200_000
_MAX_ROUNDS = 64

_FOUND = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)
_CANDIDATE = (
    "file string, block long, rel long, size long, head long, content long, whole boolean, " + _FOUND
)


def digest_of(payload: Column) -> Column:
    """Struct of the payload's bytes, its bare base32 SHA-1 and its SHA-256."""

    @F.pandas_udf("n_bytes long, digest string, key string")
    def digest(parts: pd.Series) -> pd.DataFrame:
        raw = [p.encode("utf-8", "replace") for p in parts]
        return pd.DataFrame(
            {
                "n_bytes": [len(r) for r in raw],
                "digest": [base32_sha1(r) for r in raw],
                "key": [hashlib.sha256(r).hexdigest() for r in raw],
            }
        )

    return digest(payload)


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def write_warc(pages: DataFrame, folder: str, revisit_bytes: int = 0) -> None:
    """Archives of ``pages`` (page_id, url, html) below ``folder``."""
    small_batches(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    )
    thin = stage(rows.select("page_id", digest_of(F.col("html")).alias("d")).select("page_id", "d.*"), "payloads")
    firsts = thin.where((F.col("n_bytes") >= revisit_bytes) & F.col("page_id").isNotNull()).groupBy("key")
    firsts = firsts.agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
    firsts = firsts.where("first < last").select("key", "first")
    revisits = thin.join(firsts, "key").where("page_id > first").select("page_id", "key", "first").distinct()
    revisits = stage(revisits, "revisits")

    rows = rows.withColumn("d", digest_of(F.col("html"))).select("page_id", "url", "html", "d.*")
    rows = rows.join(revisits, ["page_id", "key"], "left")
    again = F.col("first").isNotNull()
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    optional = lambda name, value: F.coalesce(line(name, value), F.lit(""))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    length = F.when(again, 0).otherwise(F.lit(len(HTTP)) + F.col("n_bytes")).cast("string")
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn("page_id")),
        line("WARC-Date", F.lit(DATE)),
        optional("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(again, line("WARC-Refers-To", urn("first"))).otherwise(""),
        F.when(again, line("WARC-Profile", F.lit(PROFILE))).otherwise(""),
        line("X-Payload-Length", F.col("n_bytes").cast("string")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", length),
        F.lit("\r\n"),
        F.when(again, "").otherwise(F.concat(F.lit(HTTP), "html")),
    )
    writer = rows.select(record.alias("value")).write.option("lineSep", END)
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Parts between version lines, with the file and the start of their split."""
    small_batches(spark)
    parts = spark.read.option("lineSep", MAGIC).text(folder)
    return parts.select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """file, block, place in the block's own bytes, and content of each part."""
    current, rel = None, 0
    for batch in batches:
        columns = (batch["file"].to_pylist(), batch["block"].to_pylist(), batch["value"])
        for file, block, value in zip(*columns):
            value = value.as_py()
            if (file, block) != current:
                current, rel = (file, block), 0
            yield file, block, rel, value
            rel += len(value) + len(MAGIC)


def parse_headers(part: bytes) -> tuple[int, dict[str, str]] | None:
    """Length of the header section and its fields, or None if it is no header section."""
    end = part.find(END.encode())
    if end < 0:
        return None
    fields = {}
    for row in part[:end].split(b"\r\n"):
        name, colon, value = row.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not fields.get("content-length", "").isdecimal():
        return None
    return end + len(END), fields


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdecimal() else None


def found_in(fields: dict[str, str], block: bytes) -> dict:
    """What the result says of one record, from its headers and its block."""
    kind = fields.get("warc-type", "")
    out = {"page_id": _page(fields.get("warc-record-id")), "record_type": kind, "refers_to": None}
    if kind == "revisit":
        length = fields.get("x-payload-length", "")
        out["payload_bytes"] = int(length) if length.isdecimal() else None
        out["payload_digest"] = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        out["refers_to"] = _page(fields.get("warc-refers-to"))
    else:
        _, _, payload = block.partition(END.encode())
        out["payload_bytes"], out["payload_digest"] = len(payload), base32_sha1(payload)
    return out


def _batch(rows: list[dict], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=kind)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Written table of candidate records: file, offset, successor, whole, and what they hold.

    ``whole`` records end before the next version line, so their block has been read already.
    """
    kind = _arrow(_CANDIDATE)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for file, block, rel, value in _placed(batches):
            row = {"file": file, "block": block, "rel": rel, "size": len(value), "whole": False}
            parsed = parse_headers(value)
            if parsed:
                head, fields = parsed
                content = int(fields["content-length"])
                whole = head + content + len(END) <= len(value)
                row |= {"head": head, "content": content, "whole": whole}
                if whole:
                    row |= found_in(fields, value[head : head + content])
            rows.append(row)
            if len(rows) == 2_000:
                yield _batch(rows, kind)
                rows = []
        yield _batch(rows, kind)

    parts = stage(_lines(spark, folder).mapInArrow(scan, _CANDIDATE), "warc-parts")
    sizes = parts.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = parts.join(bases, ["file", "block"])
    offset = F.col("base") + F.col("rel") - len(MAGIC)
    successor = offset + len(MAGIC) + F.col("head") + F.col("content") + len(END)
    placed = placed.select("*", offset.alias("offset"), successor.alias("successor"))
    return stage(placed.where("offset >= 0"), "warc-candidates")  # before the first is no record


def reachable(links: DataFrame) -> DataFrame:
    """file, offset of what pointer jumping visits from offset 0 over (file, offset, successor)."""
    state = links.select("file", "offset", F.col("successor").alias("jump"), (F.col("offset") == 0).alias("seen"))
    state = stage(state, "chain")
    for _ in range(_MAX_ROUNDS):
        # Everything seen marks where it jumps to; every jump then becomes twice as long.
        reached = state.where("seen").select("file", F.col("jump").alias("offset"), F.lit(True).alias("hit"))
        far = state.select("file", F.col("offset").alias("jump"), F.col("jump").alias("further"))
        moved = state.join(reached.distinct(), ["file", "offset"], "left").join(far, ["file", "jump"], "left")
        moved = moved.select(
            "file", "offset", F.col("further").alias("jump"), (F.col("seen") | F.coalesce("hit", F.lit(False))).alias("seen")
        )
        state = stage(moved, "chain")
        if state.where("jump IS NOT NULL AND seen").isEmpty():
            return state.where("seen").select("file", "offset")
    raise RuntimeError("an archive holds more records than pointer jumping can visit")


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record."""
    parts = candidates(spark, folder)
    seen = reachable(parts.where("successor IS NOT NULL"))
    records = parts.join(seen, ["file", "offset"])
    names = [c.split()[0] for c in _FOUND.split(", ")]
    whole = records.where("whole").select(*names)
    split = stage(records.where("NOT whole").select("file", "offset", "successor"), "warc-split")
    if split.isEmpty():
        return whole
    # Parts that lie inside a split record, by the last chain record at or before them.
    back = Window.partitionBy("file").orderBy("offset")
    chain = seen.withColumn("own", F.col("offset"))
    owners = parts.select("file", "block", "rel", "offset").join(chain, ["file", "offset"], "left")
    owners = owners.withColumn("own", F.last("own", ignorenulls=True).over(back))
    spans = split.select("file", F.col("offset").alias("own"), "successor")
    owners = owners.join(spans, ["file", "own"]).where("offset < successor")
    owners = owners.select("file", "block", "rel", "own", "offset")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _arrow("file string, block long, rel long, value binary")
        for file, block, rel, value in _placed(batches):
            yield _batch([{"file": file, "block": block, "rel": rel, "value": value}], kind)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _arrow(_FOUND)
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                raw = MAGIC.encode().join(p["value"] for p in row["parts"])
                head, fields = parse_headers(raw)
                block = raw[head : head + int(fields["content-length"])]
                if len(block) != int(fields["content-length"]):
                    raise ValueError(f"{row['file']} was split in another way when read again")
                rows.append(found_in(fields, block))
            yield _batch(rows, kind)

    lines = _lines(spark, folder).mapInArrow(again, "file string, block long, rel long, value binary")
    bodies = lines.join(owners, ["file", "block", "rel"]).groupBy("file", "own")
    bodies = bodies.agg(F.array_sort(F.collect_list(F.struct("offset", "value"))).alias("parts"))
    rebuilt = stage(bodies.select("file", "parts").mapInArrow(join, _FOUND), "warc-rebuilt")
    if rebuilt.count() != split.count():
        raise ValueError("an archive was split in another way when read again")
    return whole.unionByName(rebuilt)
