"""WARC records in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about `frame_bytes`;
a bundle ends in a skippable frame that holds the seek table (compressed and
plain size and checksum of every frame), so any Zstandard reader can unpack a
bundle and a reader with the table can start at any frame.  The index maps a
record to its bundle, frame, offset inside the plain frame and length.

Of records with equal payloads of at least `min_bytes` bytes the one with the
largest page_id is written as a response, the others as revisits of it.

Defined results: a null html is an empty payload; a null url leaves out the
target URI; rows equal in page_id and payload are each written; a null page_id
counts below every other and has no record to refer to; a record larger than a
frame gets a frame of its own; an empty table gives an empty archive.
Bundles are named by task attempt and only those in the index are read, so a
repeated task leaves no wrong record behind.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import new_folder, partitions, stored, table

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<III")

FRAME_BYTES = 1 << 20
FRAMES_A_TASK = 256
BUNDLE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
INDEX = ("page_id long, record_type string, refers_to long, bundle string, frame int, frame_start long, "
         "offset long, length long")
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "url string, payload binary")


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/"):
        path = "file:///" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One WARC/1.1 record: a response with its HTTP block, or a revisit whose
    headers name the record that holds the identical payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {urllib.parse.quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
    block = http if revisit else http + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes, start: int = 0, stop: int | None = None) -> Iterator[dict]:
    """Records of a plain frame, from offset `start` to `stop`."""
    stop = len(data) if stop is None else stop
    while start < stop:
        head_end = data.index(b"\r\n\r\n", start)
        lines = data[start:head_end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at offset {start}")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        block = data[head_end + 4: head_end + 4 + int(fields["Content-Length"])]
        start = head_end + 4 + len(block) + 4
        if fields["WARC-Type"] == "warcinfo":
            continue
        http_end = block.index(b"\r\n\r\n") + 4
        http = dict(x.split(": ", 1) for x in block[:http_end - 4].decode().split("\r\n")[1:])
        number = lambda s: None if s == "none" else int(s)
        out = {
            "page_id": number(fields["WARC-Record-ID"][len("<urn:page:"):-1]),
            "payload_bytes": int(http["Content-Length"]),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            "record_type": fields["WARC-Type"],
            "refers_to": number(fields["WARC-Refers-To"][len("<urn:page:"):-1]) if "WARC-Refers-To" in fields else None,
            "url": urllib.parse.unquote(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
            "payload": None,
        }
        if out["record_type"] == "response":
            out["payload"] = block[http_end:]
            if len(out["payload"]) != out["payload_bytes"] or digest_of(out["payload"]) != out["payload_digest"]:
                raise ValueError(f"payload of page {out['page_id']} differs from its header")
        yield out


class BundleWriter:
    """Frames of records, then the seek table."""

    def __init__(self, path: str, frame_bytes: int):
        self.path, self.frame_bytes = path, frame_bytes
        fs, inner = filesystem(path)
        self.out = fs.open_output_stream(inner, compression=None)  # frames are packed here
        self.entries: list[tuple[int, int, int]] = []
        self.at, self.buffer = 0, bytearray()
        info = b"software: ledgerstar\r\nformat: WARC File Format 1.1\r\n"
        name = path.rsplit("/", 1)[-1]
        self.buffer += (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:bundle:{name}>\r\nWARC-Date: {DATE}\r\n"
                        f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n").encode() + info + b"\r\n\r\n"

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame number, that frame's place in the bundle, offset in it."""
        if self.buffer and len(self.buffer) + len(record) > self.frame_bytes:
            self.flush()
        offset = len(self.buffer)
        self.buffer += record
        return len(self.entries), self.at, offset

    def flush(self) -> None:
        plain = bytes(self.buffer)
        packed = zstandard.ZstdCompressor(level=3).compress(plain)
        self.out.write(packed)
        self.entries.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.at += len(packed)
        self.buffer = bytearray()

    def close(self) -> None:
        if self.buffer:
            self.flush()
        table_ = b"".join(ENTRY.pack(*e) for e in self.entries) + FOOTER.pack(len(self.entries), 0x80, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table_)) + table_)
        self.out.close()


def seek_table(f) -> list[tuple[int, int, int, int]]:
    """(start, packed size, plain size, checksum) of every frame of an open bundle."""
    end = f.size()
    f.seek(end - FOOTER.size)
    n, _, magic = FOOTER.unpack(f.read(FOOTER.size))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    f.seek(end - FOOTER.size - n * ENTRY.size)
    raw, start, out = f.read(n * ENTRY.size), 0, []
    for packed, plain, check in ENTRY.iter_unpack(raw):
        out.append((start, packed, plain, check))
        start += packed
    return out


def read_frame(f, start: int, packed: int, plain: int, check: int) -> bytes:
    f.seek(start)
    data = zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=plain)
    if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
        raise ValueError("frame checksum differs")
    return data


def with_originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """pages (page_id, url, payload binary) plus refers_to: the largest page_id
    among equal payloads, null where it is the row's own.  The largest id is
    aggregated map-side, so a payload with many copies meets its join as one
    row; the copies' side of that join can be split."""
    keyed = pages.withColumn("_sha", F.sha1("payload"))
    originals = keyed.groupBy("_sha").agg(F.max("page_id").alias("_keep"))
    other = (F.col("_keep").isNotNull() & ~F.col("_keep").eqNullSafe(F.col("page_id")) & (F.length("payload") >= min_bytes))
    return keyed.join(originals.hint("merge"), "_sha").withColumn("refers_to", F.when(other, F.col("_keep"))).drop("_sha", "_keep")


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, frame_bytes: int = FRAME_BYTES,
                   bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write pages (page_id, url, html) as bundles in `folder`; the stored
    index, one row per record."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        writer, made = None, 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if writer is None:
                    writer = BundleWriter(f"{folder}/part-{task.partitionId():05d}-{made:04d}-{task.taskAttemptId()}.warc.zst", frame_bytes)
                    made += 1
                record = warc_record(row["page_id"], row["url"], row["payload"], row["refers_to"])
                frame, start, offset = writer.add(record)
                rows.append((row["page_id"], "response" if row["refers_to"] is None else "revisit", row["refers_to"], writer.path, frame, start, offset, len(record)))
                if writer.at >= bundle_bytes:
                    writer.close()
                    writer = None
            yield pa.RecordBatch.from_pydict(dict(zip(INDEX_SCHEMA.names, zip(*rows) if rows else [[]] * len(INDEX_SCHEMA), strict=True)), schema=INDEX_SCHEMA)
        if writer is not None:
            writer.close()

    spark = pages.sparkSession
    fs, inner = filesystem(folder)
    fs.create_dir(inner, recursive=True)
    payload = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    ready = with_originals(payload, min_bytes).select("page_id", "url", "payload", "refers_to")
    ordered = ready.sortWithinPartitions("page_id")
    index = ordered.mapInArrow(write, INDEX)
    path = new_folder(spark, "warc-index")
    index.write.parquet(path)
    return spark.read.schema(index.schema).parquet(path)


INDEX_SCHEMA = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("bundle", pa.string()),
                          ("frame", pa.int32()), ("frame_start", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                           ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])


def read_archives(index: DataFrame) -> DataFrame:
    """Every record of the bundles that the index names, frame by frame: one
    row per (bundle, frame) is dealt out in ranges, whose number goes by the
    frames, and a task holds one frame (and one seek table) at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, table_ = None, []
        for batch in batches:
            for row in batch.to_pylist():
                fs, inner = filesystem(row["bundle"])
                with fs.open_input_file(inner) as f:
                    if row["bundle"] != bundle:
                        bundle, table_ = row["bundle"], seek_table(f)
                    data = read_frame(f, *table_[row["frame"]])
                yield pa.RecordBatch.from_pylist(list(parse_records(data)), schema=RECORD_SCHEMA)

    spark = index.sparkSession
    frames = stored(index.select("bundle", "frame").distinct(), "warc-frames")
    n = frames.count()
    n = max(1, min(n, max(partitions(spark), -(-n // FRAMES_A_TASK))))
    # ranges of a given number: neither the planner nor adaptive execution merges them
    return frames.repartitionByRange(n, "bundle", "frame").sortWithinPartitions("bundle", "frame").mapInArrow(read, RECORDS)


def fetch(index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records of the given page_ids, each read from its frame alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, inner = filesystem(row["bundle"])
                with fs.open_input_file(inner) as f:
                    data = read_frame(f, *seek_table(f)[row["frame"]])
                found = parse_records(data, row["offset"], row["offset"] + row["length"])
                yield pa.RecordBatch.from_pylist(list(found), schema=RECORD_SCHEMA)

    wanted = index.join(ids.select(F.col("page_id").cast("long").alias("page_id")).distinct(), "page_id", "left_semi")
    return wanted.select("bundle", "frame", "offset", "length").mapInArrow(read, RECORDS)


def op10_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"), new_folder(spark, "warc"))
    return read_archives(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS keep FROM p
), b AS (
  SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: lpad(bin(strpos('0123456789abcdef', substr(h, i::INT, 1)) - 1), 4, '0')), 'string_agg', '') AS bits FROM m
)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * substr(bits, 5 * j::INT + 1, 1)::INT + 8 * substr(bits, 5 * j::INT + 2, 1)::INT + 4 * substr(bits, 5 * j::INT + 3, 1)::INT
      + 2 * substr(bits, 5 * j::INT + 4, 1)::INT + substr(bits, 5 * j::INT + 5, 1)::INT, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN keep <> page_id THEN keep END AS refers_to
FROM b
"""
