"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a bundle ends with a skippable frame that holds the seek table
(compressed and decompressed size of every frame, then their number and the seekable-format magic number), so one record is read
by decoding one frame. The index maps every record id to (bundle, frame, offset in the frame, length).

Of records with equal payloads of at least `least_bytes`, that with the largest page_id is a response and the others are
revisits that refer to it. Digests and ids are shuffled to decide that; where the repeated digests are too many to broadcast, a bitmap of
bounded size picks the rows that may be repeats, and only those are joined. Tasks write their bundles straight into the shared folder under names
of their own attempt; the index names those of the attempts that counted, so a task that is run again leaves nothing
wrong behind.

Defined results: a null html is an empty payload; a null url has no target line; a null page_id gives a record id of its
partition and row, is never referred to and is read back as null; rows that repeat the largest page_id are all responses; an empty table
gives no record; extra columns are ignored. pyarrow's file systems open the folder (local or mounted paths, S3, HDFS).
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernel.llm.common import BROADCAST_ROWS, small_batches, stash, stash_folder, table

LEAST_BYTES = 1000
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 32 << 20
#: Bits of the bitmap of repeated digests (sent as at most BITMAP / 64 rows).
BITMAP = 1 << 25
#: Most tasks that read archives.
READERS = 20_000
#: Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
INDEX_SCHEMA = "page_id {kind}, record_id string, bundle string, frame bigint, frame_offset bigint, length bigint"
READ_SCHEMA = "page_id {kind}, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to {kind}, bundle string, frame bigint, frame_offset bigint"


def open_folder(uri: str):
    """(pyarrow file system, path in it) of a folder's URI or path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", uri))


class BundleWriter:
    """Appends records to frames and frames to one bundle; `close` appends the seek table."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self.stream, self.frame_bytes = stream, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=3)
        self.parts: list[bytes] = []
        self.held = self.written = 0
        self.table: list[tuple[int, int]] = []

    def add(self, record: bytes) -> tuple[int, int]:
        """The record's frame and its offset there."""
        if self.held and self.held + len(record) > self.frame_bytes:
            self.flush()
        at = len(self.table), self.held
        self.parts.append(record)
        self.held += len(record)
        return at

    def flush(self) -> None:
        if self.parts:
            packed = self.zstd.compress(b"".join(self.parts))
            self.stream.write(packed)
            self.table.append((len(packed), self.held))
            self.written += len(packed)
            self.parts, self.held = [], 0

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *x) for x in self.table) + struct.pack("<IBI", len(self.table), 0, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries)) + entries)
        self.stream.close()


class BundleReader:
    """Reads the seek table of a bundle and any of its frames."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        count, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("not a seekable bundle")
        entry = 12 if flags & 0x80 else 8
        raw = file.read_at(count * entry, size - 9 - count * entry)
        self.frames, at = [], 0
        for i in range(count):
            packed, plain = struct.unpack_from("<II", raw, i * entry)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, number: int) -> bytes:
        import zstandard

        at, packed, plain = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, at), max_output_size=plain)


def warc_record(record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """A response record with its payload, or a revisit record with the HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}")
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(frame: bytes) -> Iterator[tuple[int, dict[str, str], bytes, int]]:
    """(offset, WARC headers, payload, full payload length) of each record of a frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        lines = frame[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at offset {at}")
        head = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        block = frame[end + 4 : end + 4 + int(head["content-length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
        yield at, head, payload, length
        at = end + 4 + len(block) + 4


def page_urn(page_id) -> str:
    return f"urn:page:{page_id}"


def _page_of(urn: str | None) -> str | None:
    return urn.strip("<>").removeprefix("urn:page:") if urn and urn.startswith("<urn:page:") else None


def with_keepers(rows: DataFrame, groups: DataFrame, most_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """rows (digest and others) with the keeper of their digest from groups (digest, keeper; stashed), else null."""
    if groups.limit(most_broadcast + 1).count() <= most_broadcast:
        return rows.join(F.broadcast(groups), "digest", "left")
    slot = lambda: F.pmod(F.xxhash64("digest"), F.lit(BITMAP))
    bit = lambda: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(slot(), F.lit(64)).cast("int"))
    words = stash(groups.groupBy(F.floor(slot() / 64).alias("_word")).agg(F.bit_or(bit()).alias("_bits")), "payload-bitmap")
    marked = rows.withColumn("_word", F.floor(slot() / 64)).join(F.broadcast(words), "_word", "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(bit()) != 0, F.lit(False))
    repeats = marked.where(maybe).drop("_word", "_bits").join(groups, "digest", "left")
    others = marked.where(~maybe).drop("_word", "_bits").withColumn("keeper", F.lit(None).cast(dict(groups.dtypes)["keeper"]))
    return repeats.unionByName(others)


def write_archives(pages: DataFrame, folder: str, date: str | None = None, least_bytes: int = LEAST_BYTES, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, most_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """Write a record per row of pages (page_id, url, html) into bundles below folder; return the index, stashed."""
    spark = pages.sparkSession
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    html = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("digest"))
    sums = pages.select("page_id", F.sha1(html).alias("digest"), F.octet_length(html).alias("n")).where(F.col("n") >= least_bytes)
    groups = stash(sums.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("keeper")).where("n > 1").drop("n"), "payloads")
    rows = with_keepers(rows, groups, most_broadcast).select("page_id", "url", "html", "digest", "keeper")
    system, base = open_folder(folder)
    system.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        files, root = open_folder(folder)
        prefix = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        writer, made, row = None, 0, 0
        for b in batches:
            ids, names, bundles, frames, offsets, lengths = [], [], [], [], [], []
            columns = [c.to_pylist() for c in b.columns]
            for page_id, url, body, digest, keeper in zip(*columns, strict=True):
                if writer is None:
                    bundle = f"{prefix}-{made}.warc.zst"
                    made += 1
                    writer = BundleWriter(files.open_output_stream(f"{root}/{bundle}", compression=None), frame_bytes)
                name = page_urn(page_id) if page_id is not None else f"urn:row:{context.partitionId()}-{row}"
                row += 1
                refers = page_urn(keeper) if keeper is not None and keeper != page_id else None
                record = warc_record(name, url, body, digest, refers, date)
                frame, offset = writer.add(record)
                for out, x in zip((ids, names, bundles, frames, offsets, lengths), (page_id, name, bundle, frame, offset, len(record)), strict=True):
                    out.append(x)
                if writer.written >= bundle_bytes:
                    writer.close()
                    writer = None
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, b.column(0).type), pa.array(names, pa.string()), pa.array(bundles, pa.string()), *[pa.array(x, pa.int64()) for x in (frames, offsets, lengths)]],
                names=["page_id", "record_id", "bundle", "frame", "frame_offset", "length"],
            )
        if writer is not None:
            writer.close()

    small_batches(spark)
    kind = dict(pages.dtypes)["page_id"]
    return stash(rows.mapInArrow(run, INDEX_SCHEMA.format(kind=kind)), "warc-index")


def read_archives(spark: SparkSession, folder: str, bundles: DataFrame, kind: str = "bigint") -> DataFrame:
    """Read every record of the named bundles (column bundle, one row each, stashed), frame by frame, bundles in tasks of their own; digests are taken from the bytes read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for b in batches:
            for bundle in b.column(0).to_pylist():
                with files.open_input_file(f"{root}/{bundle}") as file:
                    reader = BundleReader(file)
                    for number in range(len(reader.frames)):
                        out: list[tuple] = []
                        for offset, head, payload, length in parse_records(reader.frame(number)):
                            digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
                            if head["warc-type"] == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
                                raise ValueError(f"{bundle}: damaged record {head['warc-record-id']}")
                            out.append((_page_of(head["warc-record-id"]), head.get("warc-target-uri"), length, digest, head["warc-type"], _page_of(head.get("warc-refers-to")), bundle, number, offset))
                        columns = list(zip(*out, strict=True))
                        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=[*names, "bundle", "frame", "frame_offset"])

    tasks = min(READERS, max(1, bundles.count()))
    read = bundles.select("bundle").repartition(tasks).mapInArrow(run, READ_SCHEMA.format(kind="string"))
    return read.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


def read_record(folder: str, entry) -> tuple[dict[str, str], bytes]:
    """WARC headers and payload of one index entry (bundle, frame, frame_offset): decodes a single frame."""
    files, root = open_folder(folder)
    with files.open_input_file(f"{root}/{entry['bundle']}") as file:
        frame = BundleReader(file).frame(entry["frame"])
    _, head, payload, _ = next(parse_records(frame[entry["frame_offset"] :]))
    return head, payload


def query(spark, sf_dir: str) -> DataFrame:
    folder = f"{stash_folder(spark)}/warc-{uuid.uuid4().hex}"
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    index = write_archives(pages, folder)
    records = read_archives(spark, folder, stash(index.select("bundle").distinct(), "bundles"), dict(pages.dtypes)["page_id"])
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS digest FROM p),
k AS (SELECT digest, max(page_id) AS keeper FROM s WHERE n >= {LEAST_BYTES} GROUP BY digest)
SELECT page_id, n AS payload_bytes, s.digest AS payload_digest,
    CASE WHEN keeper IS NULL OR keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM s LEFT JOIN k ON s.digest = k.digest
"""
