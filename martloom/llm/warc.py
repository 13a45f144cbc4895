"""Deterministic sharded WARC archives.

Records are sorted by id into ranges, one task each. A task writes gzip members,
one per record, and starts a new file when the compressed size of the current
one reaches the limit. Files get their final name only when complete, and only
files named in the manifest, which is committed last, are part of the archive:
what a lost or repeated task left behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import text_or_empty

ROLL_BYTES = 64 << 20
# Payloads below this size are always written in full.
REVISIT_FROM = 1000
DATE = "1970-01-01T00:00:00Z"
# Fixed value: the profile of records that repeat an earlier payload.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "file string, records long, compressed_bytes long, sha256 string"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
)


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id} {digest}')}>"


def _record(row: dict) -> bytes:
    """One record, uncompressed; digests and lengths are computed from its content."""
    revisit = row["refers_to"] is not None
    payload = (row["html"] or "").encode()
    digest, size = hashlib.sha1(payload).hexdigest(), len(payload)
    payload = b"" if revisit else payload
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(row["page_id"], digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(row["url"] or "", safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", "sha1:" + _base32(digest)),
        ("WARC-Block-Digest", "sha1:" + _base32(hashlib.sha1(block).hexdigest())),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if row["page_id"] is not None:
        headers.append(("X-Page-Id", str(row["page_id"])))
    if revisit:
        headers.append(("WARC-Profile", REVISIT_PROFILE))
        headers.append(("WARC-Refers-To", _record_id(row["refers_to"], digest)))
        headers.append(("X-Refers-To-Page-Id", str(row["refers_to"])))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def classified(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Pages and, ahead of them in the archive's order, notes on which of them are revisits.

    Columns ``page_id, key, note, refers_to, url, html``. A note says that pages of
    this id and key (payload's hash) refer to another; it has no html. So payloads
    need not meet their groups: they travel once, to their place in the archive.

    Of equal payloads of at least ``revisit_from`` bytes the one with the largest
    id is written and the others refer to it. Null html is empty. Rows that repeat
    the largest id are written in full, as are rows without an id where no row of
    the group has one.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url"), text_or_empty("html").alias("html")
    ).withColumn("key", F.sha2("html", 256))
    slim = rows.where(F.octet_length("html") >= revisit_from).select("page_id", "key")
    groups = slim.groupBy("key").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n"))
    notes = (
        slim.join(groups.where("_n > 1 AND refers_to IS NOT NULL"), "key")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "key", "refers_to")
        .distinct()
    )
    return notes.selectExpr(
        "page_id", "key", "true AS note", "refers_to", "CAST(NULL AS STRING) AS url", "CAST(NULL AS STRING) AS html"
    ).union(rows.selectExpr("page_id", "key", "false AS note", "CAST(NULL AS BIGINT) AS refers_to", "url", "html"))


def write_archives(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, shards: int | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC files under ``folder`` and return the manifest."""
    spark = pages.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        task = TaskContext.get()
        shard, attempt = task.partitionId(), task.taskAttemptId()
        done, stream = [], None

        def close() -> None:
            nonlocal stream
            stream.close()
            system.move(f"{base}/{name}.{attempt}.tmp", f"{base}/{name}")
            done.append((name, records, held, whole.hexdigest()))
            stream = None

        noted = refers = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["note"]:  # right before the pages it is about
                    noted, refers = (row["page_id"], row["key"]), row["refers_to"]
                    continue
                row["refers_to"] = refers if (row["page_id"], row["key"]) == noted else None
                if stream is None:
                    system.create_dir(base, recursive=True)
                    name = f"pages-{shard:06d}-{len(done):05d}.warc.gz"
                    stream = system.open_output_stream(f"{base}/{name}.{attempt}.tmp", compression=None)
                    records, held, whole = 0, 0, hashlib.sha256()
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(_record(row)) + packer.flush()
                stream.write(member)
                whole.update(member)
                records, held = records + 1, held + len(member)
                if held >= roll_bytes:
                    close()
        if stream is not None:
            close()
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("file", "records", "compressed_bytes", "sha256"), d, strict=True)) for d in done],
            pa.schema([("file", "string"), ("records", "int64"), ("compressed_bytes", "int64"), ("sha256", "string")]),
        )

    by_id = F.col("page_id").asc_nulls_first()
    order = [by_id, F.col("key"), F.col("note").desc(), F.col("url")]
    ranged = classified(pages).repartitionByRange(shards, by_id, F.col("key")).sortWithinPartitions(*order)
    ranged.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def _members(stream) -> Iterator[bytes]:
    """Decompressed gzip members of a stream, one at a time."""
    unpacker, parts, data = zlib.decompressobj(31), [], b""
    while True:
        data = data or stream.read(1 << 20)
        if not data:
            if parts:
                raise ValueError("the archive ends within a record")
            return
        parts.append(unpacker.decompress(data))
        data = b""
        if unpacker.eof:
            yield b"".join(parts)
            data = unpacker.unused_data
            unpacker, parts = zlib.decompressobj(31), []


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if line)


def _parse(record: bytes) -> dict:
    """Fields and payload of a record, its lengths and digests checked."""
    head, rest = record.split(b"\r\n\r\n", 1)
    fields = _fields(head)
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or "sha1:" + _base32(hashlib.sha1(block).hexdigest()) != fields["WARC-Block-Digest"]:
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    http, payload = block.split(b"\r\n\r\n", 1)
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(_fields(http)["Content-Length"])
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    number = lambda key: int(fields[key]) if key in fields else None
    return {
        "page_id": number("X-Page-Id"),
        "url": fields["WARC-Target-URI"],
        "record_type": kind,
        "refers_to": number("X-Refers-To-Page-Id"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload,
    }


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """Records of the archive's manifest; with ``payloads`` also their content (revisits have none)."""
    schema = RECORDS + (", payload binary" if payloads else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        types = [("page_id", "int64"), ("url", "string"), ("record_type", "string"), ("refers_to", "int64")]
        types += [("payload_bytes", "int64"), ("payload_digest", "string")]
        types = pa.schema(types + ([("payload", "binary")] if payloads else []))
        for batch in batches:
            for name, expected in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist(), strict=True):
                rows, held, seen = [], 0, 0
                with system.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for member in _members(stream):
                        rows.append(_parse(member))
                        seen, held = seen + 1, held + (len(member) if payloads else 200)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, types)
                            rows, held = [], 0
                if seen != expected:
                    raise ValueError(f"{name} holds {seen} records, its manifest says {expected}")
                yield pa.RecordBatch.from_pylist(rows, types)

    files = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").select("file", "records")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(parts, "file").mapInArrow(read, schema)
