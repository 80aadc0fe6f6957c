"""Web archives as seekable Zstandard bundles.

A bundle is one file. Records are gathered into frames that can be decompressed each
on its own; a table of the frames' sizes ends the file, in a frame that other readers
skip. The index has a row per record: its bundle, its frame's place there and its
place in the frame, so one record costs one seek and one frame.

Payloads are compared by SHA-1 and length. Of equal payloads of at least
``min_revisit`` bytes the one with the largest id is a response record, the others
are revisit records that refer to it. Groups of copies are summed up before anything
is shuffled, and a hot group is broadcast as one row.

A task writes to a name of its own attempt, and the index lists only what committed
tasks wrote, so a lost executor leaves at most a file that nobody reads. The folder
must be shared by the executors; any file system that Arrow knows will do.

Defined results: a null payload is empty. A null id is never the largest: with others
in its group it is a revisit, in a group of null ids all are responses. Rows repeating
id and payload have one record each, of one record identifier. A null address leaves
its header out. An empty table writes no bundle. Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import stored, text_or_empty, with_lookup

MIN_REVISIT = 1000
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 3
CAPTURED = "2024-01-01T00:00:00Z"

# Fixed values of the Zstandard seekable format and of web archives.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

INDEX = "record_id string, bundle string, frame_start long, frame_bytes long, record_start long, record_bytes long"
RECORD = "id {}, payload_bytes long, payload_digest string, record_type string, refers_to {}, url string, payload binary"


def record_id(page: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {digest}')}>"


def record_bytes(page: object, url: str | None, payload: bytes, digest: str, kind: str, refers_to: object) -> bytes:
    block = HTTP_HEAD + payload if kind == "response" else HTTP_HEAD
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(page, digest),
        "WARC-Date": CAPTURED,
        "WARC-Target-URI": None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]"),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "WARC-Profile": REVISIT_PROFILE if kind == "revisit" else None,
        "WARC-Refers-To": record_id(refers_to, digest) if kind == "revisit" else None,
        "Page-Id": page,
        "Refers-To-Page-Id": refers_to if kind == "revisit" else None,
        "Payload-Length": len(payload),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    lines = "".join(f"{name}: {value}\r\n" for name, value in head.items() if value is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_records(frame: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of each record of a frame."""
    at = 0
    while at < len(frame):
        body = frame.index(b"\r\n\r\n", at) + 4
        version, *lines = frame[at : body - 4].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no record at {at}")
        head = dict(line.split(": ", 1) for line in lines)
        end = body + int(head["Content-Length"])
        block = frame[body:end]
        yield head, block[block.index(b"\r\n\r\n") + 4 :]
        at = end + 4


class Bundle:
    """A file being written: frames, then the table of their sizes."""

    def __init__(self, folder: str, name: str) -> None:
        self.path = f"{folder}/{name}.warc.zst"
        system, place = FileSystem.from_uri(self.path)
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.file = system.open_output_stream(place, compression=None)
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.sizes: list[tuple[int, int]] = []
        self.written, self.held, self.rows, self.index = 0, bytearray(), [], []

    def add(self, name: str, record: bytes) -> None:
        self.rows.append((name, len(self.held), len(record)))
        self.held += record
        if len(self.held) >= FRAME_BYTES:
            self.end_frame()

    def end_frame(self) -> None:
        packed = self.packer.compress(bytes(self.held))
        self.index.extend((name, self.path, self.written, len(packed), at, size) for name, at, size in self.rows)
        self.sizes.append((len(packed), len(self.held)))
        self.file.write(packed)
        self.written += len(packed)
        self.held, self.rows = bytearray(), []

    def close(self) -> pa.RecordBatch:
        if self.rows:
            self.end_frame()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.file.close()
        names = [field.split(" ")[0] for field in INDEX.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*self.index)], names)


def write_rows(folder: str):
    """Rows (id, url, html, digest, kind, refers_to) into bundles of the task; gives their index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, bundle = TaskContext.get(), 0, None
        for batch in batches:
            for page, url, html, digest, kind, refers_to in zip(*(column.to_pylist() for column in batch.columns)):
                if bundle is None:
                    bundle = Bundle(folder, f"{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}")
                    number += 1
                bundle.add(record_id(page, digest), record_bytes(page, url, html.encode(), digest, kind, refers_to))
                if bundle.written >= BUNDLE_BYTES:
                    yield bundle.close()
                    bundle = None
        if bundle is not None:
            yield bundle.close()

    return run


def with_types(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_revisit: int) -> DataFrame:
    """(id, url, html, digest, kind, refers_to) of each page."""
    html = text_or_empty(html_col)
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html"), F.sha1(html).alias("digest")
    ).withColumn("h", F.xxhash64("digest", F.octet_length("html")))
    small = stored(rows.select("id", "h", "digest", F.octet_length("html").alias("size")), "payloads")
    groups = (
        small.filter(F.col("size") >= min_revisit)
        .groupBy("h", "digest")
        .agg(F.max("id").alias("keep"), F.count("*").alias("n"))
        .filter("n > 1")
        .groupBy("h")
        .agg(F.sum("n").alias("n"), F.collect_list(F.struct("digest", "keep")).alias("groups"))
    )
    groups = stored(groups, "copies")
    total = groups.agg(F.sum("n")).first()[0] or 0
    typed = with_lookup(rows, groups, "h", "n", F.xxhash64("id", "digest"), total)
    mine = F.get(F.filter("groups", lambda x: x["digest"] == F.col("digest")), F.lit(0))
    typed = typed.withColumn("keep", mine["keep"])
    revisit = F.col("keep").isNotNull() & ~F.col("id").eqNullSafe(F.col("keep"))
    return typed.select(
        "id", "url", "html", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("keep")).alias("refers_to"),
    )


def write_bundles(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_revisit: int = MIN_REVISIT,
) -> DataFrame:
    """Writes the pages as bundles below a shared folder; gives the index of their records."""
    typed = with_types(pages, id_col, url_col, html_col, min_revisit)
    return stored(typed.mapInArrow(write_rows(folder), INDEX), "warc-index")


def seek_table(path: str) -> list[tuple[int, int]]:
    """(start, size) of each frame of a bundle, from its last bytes."""
    system, place = FileSystem.from_uri(path)
    with system.open_input_file(place) as file:
        size = file.size()
        count, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} ends without a seek table")
        sizes = [x for x, _ in struct.iter_unpack("<II", file.read_at(8 * count, size - 9 - 8 * count))]
    starts = [0]
    for x in sizes:
        starts.append(starts[-1] + x)
    return list(zip(starts, sizes))


def read_frame(path: str, start: int, size: int) -> bytes:
    system, place = FileSystem.from_uri(path)
    with system.open_input_file(place) as file:
        return zstandard.ZstdDecompressor().decompress(file.read_at(size, start))


def frame_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            starts, sizes = zip(*seek_table(path))
            yield pa.RecordBatch.from_pydict(
                {"bundle": [path] * len(starts), "frame_start": list(starts), "frame_bytes": list(sizes)}
            )


def decoded(head: dict[str, str], payload: bytes) -> tuple:
    """The record's row; a response whose payload does not have its digest is an error."""
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind, length = head["WARC-Type"], int(head["Payload-Length"])
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload in {head['WARC-Record-ID']}")
    body = payload if kind == "response" else None
    return head.get("Page-Id"), length, digest, kind, head.get("Refers-To-Page-Id"), head.get("WARC-Target-URI"), body


def record_rows(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.binary()]
        for batch in batches:
            for path, start, size in zip(*(column.to_pylist() for column in batch.columns)):
                rows = [decoded(*record) for record in parse_records(read_frame(path, start, size))]
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                if not with_payload:
                    columns[-1] = pa.nulls(len(rows), pa.binary())
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def read_bundles(spark: SparkSession, bundles: DataFrame, id_type: str = "long", with_payload: bool = True) -> DataFrame:
    """All records of the bundles listed in column ``bundle``, frame by frame."""
    paths = bundles.select("bundle").distinct()
    frames = stored(paths.mapInArrow(frame_rows, "bundle string, frame_start long, frame_bytes long"), "frames")
    parts = max(1, frames.count() // 8)
    records = frames.repartition(parts).mapInArrow(record_rows(with_payload), RECORD.format("string", "string"))
    return records.withColumns({name: F.col(name).cast(id_type) for name in ("id", "refers_to")})


def fetch_records(index: DataFrame) -> DataFrame:
    """The records of these index rows, each by one seek: (record_id, headers, payload)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, path, start, size, at, length in zip(*(column.to_pylist() for column in batch.columns)):
                head, payload = next(parse_records(read_frame(path, start, size)[at : at + length]))
                yield pa.RecordBatch.from_pydict(
                    {"record_id": [name], "headers": pa.array([list(head.items())], pa.map_(pa.string(), pa.string())), "payload": [payload]}
                )

    names = [field.split(" ")[0] for field in INDEX.split(", ")]
    return index.select(names).mapInArrow(run, "record_id string, headers map<string,string>, payload binary")
