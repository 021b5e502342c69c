"""Web archives as seekable Zstandard bundles.

Records are grouped into independent frames; a table of the frames' sizes, in the skippable
frame that the seekable format puts last, lets a reader decompress one frame alone. An index
maps each record to its bundle, frame and place within the frame. A payload that occurred
before is a revisit record of the first.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinitext.llm.common import stored
from affinitext.session import shared_folder

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 32 << 20
LEVEL = 3
#: Payloads of fewer bytes are always stored.
LEAST_BYTES = 0
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id bigint, _row string, bundle string, frame int, offset bigint, length bigint"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The last frame of a bundle: compressed and plain size of each frame."""
    body = b"".join(struct.pack("<II", a, b) for a, b in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def frames_of(bundle: bytes) -> list[tuple[int, int]]:
    """Where each frame begins and ends, from the table at the bundle's end."""
    n, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    table = bundle[-9 - 8 * n : -9]
    out, at = [], 0
    for size, _ in struct.iter_unpack("<II", table):
        out.append((at, at + size))
        at += size
    return out


def record(row: str, page_id, url: str, payload: bytes, refers_to) -> bytes:
    """A WARC record; header values are percent-free one-liners, null ids are left out."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, row)}>",
        "WARC-Date: 1970-01-01T00:00:00Z", "WARC-Target-URI: " + " ".join(url.split()),
        f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/octet-stream",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page: {refers_to}"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, body[: int(fields["Content-Length"])]


class Bundle:
    """Frames of one archive file as they are filled."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        self.out, self.frames, self.held, self.size = io.BytesIO(), [], [], 0
        self.rows: list[tuple] = []

    def add(self, page_id, row: str, data: bytes) -> None:
        self.rows.append((page_id, row, self.path, len(self.frames), self.size, len(data)))
        self.held.append(data)
        self.size += len(data)
        if self.size >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.held:
            plain = b"".join(self.held)
            frame = zstandard.ZstdCompressor(LEVEL).compress(plain)
            self.out.write(frame)
            self.frames.append((len(frame), len(plain)))
            self.held, self.size = [], 0

    def save(self) -> pa.RecordBatch:
        from pyarrow import fs

        self.close_frame()
        self.out.write(seek_table(self.frames))
        store, path = fs.FileSystem.from_uri(self.path)
        with store.open_output_stream(path, compression=None) as file:
            file.write(self.out.getbuffer())
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*self.rows, strict=True), kinds, strict=True)],
            [f.split()[0] for f in INDEX.split(", ")],
        )


def write_archives(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Write a record per page and return the index of the records.

    Of equal payloads that of the smallest page_id is stored, further rows revisit it; rows
    that repeat that page_id and url are responses too. A null html is an empty payload, a
    null url an empty one; an empty table writes no bundle. Every bundle has a name of its
    own, and only bundles that the index names count, so a task that runs twice does no harm.
    """
    # A folder without a scheme is where Hadoop puts it (fs.defaultFS), as Spark reads it.
    jvm = pages.sparkSession.sparkContext._jvm
    conf = pages.sparkSession._jsparkSession.sessionState().newHadoopConf()
    base = jvm.org.apache.hadoop.fs.Path(shared_folder(pages.sparkSession))
    store = base.getFileSystem(conf)
    folder = f"{store.makeQualified(base).toString().rstrip('/')}/warc-{uuid.uuid4().hex}"
    store.mkdirs(jvm.org.apache.hadoop.fs.Path(folder))
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        html.alias("html"), F.sha1(html).alias("_sha"),
    )
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", "url")).alias("_first")
    firsts = rows.filter(F.octet_length("html") >= least).groupBy("_sha").agg(first, F.count("*").alias("_n")).filter(
        "_n > 1"
    ).select("_sha", F.col("_first.page_id").alias("_to"), F.col("_first.url").alias("_url"))
    told = rows.join(firsts, "_sha", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = Bundle(folder)
        for batch in batches:
            for page_id, url, html, to, to_url in zip(*[c for c in batch.columns], strict=True):
                page_id, url, payload = page_id.as_py(), url.as_py(), html.as_buffer().to_pybytes()
                original = to_url.as_py() is None or (page_id == to.as_py() and url == to_url.as_py())
                row = uuid.uuid4().hex
                bundle.add(page_id, row, record(row, page_id, url, payload, None if original else to.as_py()))
                if bundle.out.tell() >= BUNDLE_BYTES:
                    yield bundle.save()
                    bundle = Bundle(folder)
        if bundle.rows:
            yield bundle.save()

    return stored(told.select("page_id", "url", "html", "_to", "_url").mapInArrow(run, INDEX))


READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def read_archives(index: DataFrame) -> DataFrame:
    """Every record of the bundles in the index, read from its frame at its place."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(key[0].as_py())
        with store.open_input_file(path) as file:
            n = struct.unpack("<IBI", file.read_at(9, file.size() - 9))[0]
            tail = file.read_at(9 + 8 * n, file.size() - 9 - 8 * n)
            frames, out, opened, plain = frames_of(tail), [], -1, b""
            for _, frame, offset, length in sorted(zip(*[group.column(c).to_pylist() for c in ("_row", "frame", "offset", "length")], strict=True), key=lambda x: x[1:3]):
                if frame != opened:
                    lo, hi = frames[frame]
                    plain, opened = zstandard.ZstdDecompressor().decompress(file.read_at(hi - lo, lo)), frame
                fields, body = parse(plain[offset : offset + length])
                number = {k: int(fields[k]) if k in fields else None for k in ("X-Page-ID", "X-Refers-To-Page")}
                out.append((number["X-Page-ID"], int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"][5:],
                            fields["WARC-Type"], number["X-Refers-To-Page"], body))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                        names=[f.split()[0] for f in READ.split(", ")])

    return index.groupBy("bundle").applyInArrow(run, READ)
