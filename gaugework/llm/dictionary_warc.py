"""WARC archives with an embedded Zstandard dictionary.

Each task writes its pages into archives of about `ARCHIVE_BYTES`. The first records, up to `SAMPLE_BYTES`, are held until there
are enough to train the archive's dictionary; a leading skippable frame embeds it, and every record is a frame of its own,
compressed with it. Where too little is there to train on, the dictionary is the first records' bytes themselves.

The archives lie in a folder all executors share. A file's name holds a random part, so a repeated task writes another file, and
only what the manifest names is ever read; the manifest is a Parquet table that Spark commits as a whole.

Of pages with equal payloads of at least `LEAST` bytes, the one with the least page_id is the response; the others become
revisit records that refer to it and carry no payload. A hot payload moves through no single task: groups are narrow rows
that combine before the shuffle.

Defined results: a null html is an empty payload; a null url is written as empty; a null page_id counts as larger than all
others. Rows that share the least page_id of a payload are all responses. An empty table gives an empty result; other
columns play no role.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.frames import stored
from gaugework.session import new_folder

LEAST = 100
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 64 << 20, 2 << 20, 64 << 10
LEVEL = 3
READ_BYTES = 1 << 16
SKIPPABLE = 0x184D2A5D  # fixed: the frame type that archives use for their dictionary
_DATE = "2020-01-01T00:00:00Z"
_END = 1 << 62


def record(page_id, url: str, digest: str, size: int, refers_to, payload: bytes) -> bytes:
    """One WARC record; a revisit has no payload."""
    revisit = refers_to is not None
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}", "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"), f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}",
    ]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    return fields, body.partition(b"\r\n\r\n")[2]


def dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES] or b"\0" * 8


class Archive:
    """One file: the dictionary's frame, then a frame for each record."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        fs, at = pafs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")
        self.file, self.held, self.held_bytes, self.bytes, self.records, self.writer = fs.open_output_stream(at, compression=None), [], 0, 0, 0, None

    def add(self, raw: bytes) -> None:
        self.records += 1
        if self.writer is None:
            self.held.append(raw)
            self.held_bytes += len(raw)
            if self.held_bytes >= SAMPLE_BYTES:
                self.open()
        else:
            self.put(self.writer.compress(raw))

    def put(self, data: bytes) -> None:
        self.file.write(data)
        self.bytes += len(data)

    def open(self) -> None:
        trained = dictionary(self.held)
        self.put(struct.pack("<II", SKIPPABLE, len(trained)) + trained)
        self.writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained), write_checksum=True)
        for raw in self.held:
            self.put(self.writer.compress(raw))
        self.held = []

    def close(self) -> tuple[str, int, int]:
        if self.writer is None:
            self.open()
        self.file.close()
        return self.path, self.records, self.bytes


def records_of(path: str) -> Iterator[bytes]:
    """The records of an archive, one after the other."""
    fs, at = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    with fs.open_input_stream(at, compression=None) as file:
        magic, size = struct.unpack("<II", file.read(8))
        if magic != SKIPPABLE:
            raise ValueError(f"{path} has no dictionary frame")
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(file.read(size)))
        rest = b""
        while True:
            rest = rest or file.read(READ_BYTES)
            if not rest:
                return
            frame, out = reader.decompressobj(), io.BytesIO()
            while not frame.eof:
                if not rest:
                    rest = file.read(READ_BYTES)
                    if not rest:
                        raise ValueError(f"{path} ends within a record")
                out.write(frame.decompress(rest))
                rest = frame.unused_data if frame.eof else b""
            yield out.getvalue()


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write `pages` (page_id, url, html) as archives into `folder`; the manifest: (path, records, bytes) of each."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("html"),
    ).withColumns({"digest": F.sha2("html", 256), "size": F.octet_length("html").cast("long"), "_id": F.coalesce("page_id", F.lit(_END))})
    groups = rows.where(F.col("size") >= LEAST).groupBy("digest").agg(F.min("_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = F.col("_id") > F.col("first")
    every = rows.join(groups, "digest", "left").select(
        "page_id", "url", F.when(later, F.lit(b"")).otherwise(F.col("html")).alias("html"), "digest", "size", F.when(later, F.col("first")).alias("refers_to"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                page_id, url, html, digest, size, refers_to = row
                archive = archive or Archive(folder)
                archive.add(record(page_id, url, digest, size, refers_to, html))
                if archive.bytes >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), *[pa.array([d[k] for d in done], pa.int64()) for k in (1, 2)]], names=["path", "records", "bytes"])

    manifest = every.mapInArrow(run, "path string, records long, bytes long")
    return stored(manifest, "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of every record of the archives.

    Digest and length of a response come from its payload; the record is refused if its header says otherwise.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_pylist(rows, pa.schema([
                ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
            ]))

        for b in batches:
            for path in b.column(0).to_pylist():
                rows, held = [], 0
                for raw in records_of(path):
                    fields, payload = parsed(raw)
                    page = fields["WARC-Record-ID"][10:-1]
                    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["X-Payload-Length"])
                    revisit = fields["WARC-Type"] == "revisit"
                    if not revisit and (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
                        raise ValueError(f"{path}: page {page} is damaged")
                    rows.append({
                        "page_id": int(page) if page else None, "url": fields["WARC-Target-URI"], "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
                        "refers_to": int(fields["WARC-Refers-To"][10:-1]) if revisit else None, "payload": payload,
                    })
                    held += len(payload)
                    if len(rows) >= 2000 or held >= 16 << 20:
                        yield out(rows)
                        rows, held = [], 0
                yield out(rows)

    paths = manifest.select("path")
    return paths.repartition(max(1, paths.count()), "path").mapInArrow(run, schema)


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages into a new shared folder and read every record back."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    return read(write(pages, folder))
