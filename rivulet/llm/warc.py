"""WARC archives with a shared Zstandard dictionary.

Every archive is one file: a skippable frame that holds a dictionary trained on records of that
archive, then one Zstandard frame per record, so a reader can start at any record. Records of equal
payload are written once as ``response``; the others become ``revisit`` records that name it.

Tasks write drafts under names of their own into the folder given; the finished job's list of drafts is
what a second, small job renames to archives. A task that ran twice leaves a draft that nobody reads,
never a double or a mixed archive. The folder must be reachable by all executors (any URI pyarrow knows).
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Uncompressed bytes after which an archive is closed, so a reader never holds more than one such file.
ARCHIVE_BYTES = 16 << 20
#: Size of a dictionary, and the bytes of records at the start of an archive it is trained on.
DICTIONARY_BYTES, TRAINING_BYTES = 32 << 10, 2 << 20
LEVEL = 6

# Fixed values of the formats: the skippable frame's magic number, the media type and the profile.
_DICTIONARY_FRAME = 0x184D2A5D
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_STEP = 8 << 10  # bytes handed to the decompressor at a time
_DATE = "1970-01-01T00:00:00Z"  # the table has no time of capture


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32 without a prefix."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_roles(pages: DataFrame, id: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """``pages`` plus ``_digest`` and ``_origin``: null for a response, for a revisit the page it repeats.

    Among equal payloads of at least ``min_bytes`` bytes the largest id is the response. Digests are
    counted per task before the shuffle, and only copies are joined back, by digest.
    """
    data = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    keyed = pages.withColumn("_digest", F.sha1(data)).withColumn("_bytes", F.octet_length(data))
    repeated = (
        keyed.where(F.col("_bytes") >= min_bytes)
        .groupBy("_digest")
        .agg(F.max(id).alias("_last"), F.count(F.lit(1)).alias("_copies"))
        .where(F.col("_copies") > 1)
        .select("_digest", "_last")
    )
    joined = keyed.join(repeated, "_digest", "left")
    origin = F.when((F.col("_bytes") >= min_bytes) & (F.col("_last") != F.coalesce(id, F.lit(-(2**63)))), F.col("_last"))
    return joined.withColumn("_origin", origin).drop("_last")


def _record_id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _page_of(record_id: str | None) -> int | None:
    page = (record_id or "").removeprefix("<urn:page:").removesuffix(">")
    return int(page) if page.lstrip("-").isdigit() else None


def record(page: int | None, url: str | None, payload: bytes, origin: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header, with the length of the payload it leaves out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if origin is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if origin is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {urllib.parse.quote(url or 'about:blank', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if origin is not None:
        head[2:2] = [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(origin)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def pack(records: list[bytes]) -> bytes:
    """The bytes of one archive. Too few or too uniform records leave the dictionary empty."""
    sample, size = [], 0
    for item in records:
        if size >= TRAINING_BYTES:
            break
        sample.append(item)
        size += len(item)
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, sample, level=LEVEL, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        dictionary = b""
    tool = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True
    )
    frames = [struct.pack("<II", _DICTIONARY_FRAME, len(dictionary)), dictionary]
    return b"".join([*frames, *map(tool.compress, records)])


def unpack(archive: bytes) -> Iterator[bytes]:
    """The records of one archive, in order."""
    magic, size = struct.unpack_from("<II", archive)
    if magic != _DICTIONARY_FRAME:
        raise ValueError("no dictionary frame at the start")
    dictionary, at = archive[8 : 8 + size], 8 + size
    tool = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    rest = memoryview(archive)
    while at < len(archive):
        frame, parts = tool.decompressobj(), []
        while not frame.eof:
            if at >= len(archive):
                raise ValueError("the last frame is cut off")
            parts.append(frame.decompress(rest[at : at + _STEP]))
            at += _STEP
        at = min(at, len(archive)) - len(frame.unused_data)
        yield b"".join(parts)


def parse(item: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC header, HTTP header and payload of a record."""
    head, _, rest = item.partition(b"\r\n\r\n")
    warc = _fields(head)
    http, _, payload = rest[: int(warc["content-length"])].partition(b"\r\n\r\n")
    return warc, _fields(http), payload


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}


def write_archives(pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` under ``folder``, now; a row ``path, n_records`` per archive.

    Null payloads are empty ones, a null URL is ``about:blank``. Equal rows (same id and payload) are
    all responses, and so are rows of equal payload that have no id at all; an empty table has no archive.
    """
    rows = with_roles(
        pages.select(F.col(id).alias("_page"), F.col(url).alias("_url"), F.col(html).alias("_html")),
        "_page", "_html", min_bytes,
    ).select("_page", "_url", F.coalesce("_html", F.lit("")).alias("_html"), "_origin")
    drafts = f"{folder.rstrip('/')}-drafts"
    rows.mapInArrow(_writer(folder), "draft string, path string, n_records long").write.parquet(drafts)
    listed = pages.sparkSession.read.parquet(drafts)
    archives = f"{folder.rstrip('/')}-archives"
    listed.mapInArrow(_publisher(folder), "path string, n_records long").write.parquet(archives)
    return pages.sparkSession.read.parquet(archives)


def _writer(folder: str):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            draft = posixpath.join(root, f".{uuid.uuid4().hex}.draft")
            with store.open_output_stream(draft, compression=None) as out:
                out.write(pack(held))
            name = posixpath.join(root, f"part-{task:05d}-{number:05d}.warc.zst")
            return pa.RecordBatch.from_pydict(
                {"draft": [draft], "path": [name], "n_records": pa.array([len(held)], pa.int64())}
            )

        for part in parts:
            for page, link, text, origin in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                item = record(page, link, text.encode(), origin)
                held.append(item)
                size += len(item)
                if size >= ARCHIVE_BYTES:
                    yield close()
                    number, held, size = number + 1, [], 0
        if held:
            yield close()

    return batches


def _publisher(folder: str):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pyarrow.fs.FileSystem.from_uri(folder)
        for part in parts:
            for draft, path in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if store.get_file_info(draft).is_file:  # else an earlier attempt has renamed it
                    store.move(draft, path)
            yield part.select(["path", "n_records"])

    return batches


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records under ``folder``: page, type, URL, digest, payload and its length, and the page referred to."""
    scan = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst")
    files = scan.load(folder).select("content")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for archive in part.column(0):
                held: list[tuple] = []
                for item in unpack(archive.as_buffer().to_pybytes()):
                    warc, http, payload = parse(item)
                    response = warc["warc-type"] == "response"
                    held.append(
                        (
                            _page_of(warc["warc-record-id"]), warc["warc-type"], warc["warc-target-uri"],
                            warc["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"]),
                            payload if response else None, _page_of(warc.get("warc-refers-to")),
                        )
                    )
                    if len(held) == 1024:
                        yield _batch(held)
                        held = []
                if held:
                    yield _batch(held)

    return files.mapInArrow(batches, RECORDS)


RECORDS = (
    "page_id long, record_type string, url string, payload_digest string, payload_bytes long, payload binary, "
    "refers_to long"
)
_KINDS = {"page_id": pa.int64(), "record_type": pa.string(), "url": pa.string(), "payload_digest": pa.string(),
          "payload_bytes": pa.int64(), "payload": pa.binary(), "refers_to": pa.int64()}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, _KINDS.values(), strict=True)], names=list(_KINDS)
    )
