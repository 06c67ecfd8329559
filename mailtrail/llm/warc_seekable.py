"""WARC archives as seekable Zstandard bundles.

A task groups its records into independent Zstandard frames, ends each bundle with the seek
table of the seekable format (a skippable frame, which plain decoders pass over) and maps every
record to its frame and its offset there. Bundles are rows of a Parquet table: Spark commits them,
so a repeated task leaves no second copy, in whatever store it writes to; ``export`` makes files
of them. The bytes of a row are a whole ``.warc.zst`` file.

Of records with equal payloads of at least ``REVISIT_BYTES`` those with the smallest page_id are
responses, the others revisit that page_id. A null html is an empty payload. A null page_id comes
after all others. Repeated rows with the smallest page_id are all responses. A null url is left out.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept

REVISIT_BYTES = 100
#: Bytes of records in a frame, of compressed frames in a bundle; a longer record is a frame alone.
FRAME_BYTES, BUNDLE_BYTES = 256 << 10, 4 << 20

# Fixed values of the formats.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_INDEX = pa.struct([("page_id", pa.int64()), ("frame", pa.int32()), ("frame_start", pa.int64()),
                    ("frame_bytes", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
_INDEX_SQL = "array<struct<page_id:bigint,frame:int,frame_start:bigint,frame_bytes:bigint," \
    "offset:bigint,length:bigint>>"


def record_types(pages: DataFrame) -> DataFrame:
    """pages with digest, n_bytes and refers_to (null for responses)."""
    html = F.coalesce("html", F.lit(""))
    told = pages.select(
        "page_id", "url", "html", F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("n_bytes")
    )
    # One row per payload that recurs; a common payload is combined on the map side.
    first = (
        told.filter(F.col("n_bytes") >= REVISIT_BYTES)
        .groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1 and first_id is not null").drop("n")
    )
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id"))
    return told.join(first, "digest", "left").select(
        *told.columns, F.when(later, F.col("first_id")).alias("refers_to")
    )


def _clean(value: str) -> str:
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in value)


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response, or a revisit that has the headers of its response alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z",
        *([f"WARC-Target-URI: {_clean(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
          if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for (compressed, decompressed) sizes."""
    body = b"".join(struct.pack("<II", *x) for x in frames)
    body += struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def frame_places(bundle: bytes) -> list[tuple[int, int]]:
    """(start, compressed size) of each frame, from the table at the bundle's end."""
    count, flags, magic = struct.unpack_from("<IBI", bundle, len(bundle) - 9)
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    at, out, start = len(bundle) - 9 - count * width, [], 0
    for k in range(count):
        size = struct.unpack_from("<I", bundle, at + k * width)[0]
        out.append((start, size))
        start += size
    return out


class _Bundle:
    """Frames as they fill, and where each record went."""

    def __init__(self):
        self.packer = zstandard.ZstdCompressor(level=3)
        self.frames, self.sizes, self.index = [], [], []
        self.raw, self.waiting, self.filled, self.bytes = [], [], 0, 0

    def add(self, page_id: int | None, record: bytes) -> None:
        self.waiting.append((page_id, self.filled, len(record)))
        self.raw.append(record)
        self.filled += len(record)
        if self.filled >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.raw:
            frame = self.packer.compress(b"".join(self.raw))
            self.index += [
                {"page_id": p, "frame": len(self.frames), "frame_start": self.bytes,
                 "frame_bytes": len(frame), "offset": at, "length": n}
                for p, at, n in self.waiting
            ]
            self.frames.append(frame)
            self.sizes.append((len(frame), self.filled))
            self.bytes += len(frame)
            self.raw, self.waiting, self.filled = [], [], 0

    def row(self, name: str) -> pa.RecordBatch:
        self.close_frame()
        whole = b"".join(self.frames) + seek_table(self.sizes)
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([whole], pa.binary()), pa.array([self.index], pa.list_(_INDEX))],
            names=["archive", "bundle", "index"],
        )


def _bundle_rows(batches):
    part, n, open_bundle = TaskContext.get().partitionId(), 0, _Bundle()
    for batch in batches:
        columns = [batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to")]
        for k in range(batch.num_rows):
            page_id, url, html, digest, refers_to = (c[k].as_py() for c in columns)
            open_bundle.add(
                page_id, warc_record(page_id, url, (html or "").encode(), digest, refers_to)
            )
            if open_bundle.bytes >= BUNDLE_BYTES:
                yield open_bundle.row(f"{part:06d}-{n:06d}.warc.zst")
                n, open_bundle = n + 1, _Bundle()
    if open_bundle.raw or open_bundle.frames:
        yield open_bundle.row(f"{part:06d}-{n:06d}.warc.zst")


def write_archives(pages: DataFrame) -> DataFrame:
    """archive (file name), bundle (its bytes) and index (place of each record), written."""
    rows = record_types(pages).mapInArrow(
        _bundle_rows, f"archive string, bundle binary, index {_INDEX_SQL}"
    )
    return kept(rows, "warc")


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(x.split(": ", 1) for x in lines)
        block = end + 4
        at = block + int(headers["Content-Length"]) + 4
        yield headers, data[block : at - 4]


def _id(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _told(headers: dict[str, str], block: bytes) -> tuple:
    """page_id, url, record_type, digest, n_bytes, refers_to, payload."""
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    length = int(http.rpartition(b"Content-Length: ")[2])
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    refers = _id(headers["WARC-Refers-To"]) if kind == "revisit" else None
    return (_id(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind, digest, length,
            refers, payload if kind == "response" else None)


_TOLD = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
         ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
         ("payload", pa.binary())]
_TOLD_SQL = "page_id bigint, url string, record_type string, payload_digest string, " \
    "payload_bytes bigint, refers_to bigint, payload binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(_TOLD)
    return pa.RecordBatch.from_arrays(
        [pa.array(x, kind) for x, (_, kind) in zip(columns, _TOLD)], names=[n for n, _ in _TOLD]
    )


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the bundles, frame by frame; payloads are checked against their digests."""

    def run(batches):
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for value in batch.column("bundle"):
                bundle = value.as_py()
                for start, size in frame_places(bundle):
                    rows = [_told(*x) for x in parse_records(opener.decompress(bundle[start : start + size]))]
                    yield _batch(rows if payloads else [(*x[:-1], None) for x in rows])

    return archives.select("bundle").mapInArrow(run, _TOLD_SQL)


def record_index(archives: DataFrame) -> DataFrame:
    """archive, page_id, frame, its place in the bundle, and the record's place in the frame."""
    return archives.select("archive", F.explode("index").alias("i")).select("archive", "i.*")


def look_up(archives: DataFrame, wanted: DataFrame) -> DataFrame:
    """The records of the page_ids in ``wanted``: of their frames alone are decompressed."""
    places = record_index(archives).join(wanted.select("page_id").distinct(), "page_id")
    frames = places.groupBy("archive", "frame_start", "frame_bytes").agg(
        F.collect_list(F.struct("offset", "length")).alias("spots")
    )
    cut = F.expr("substring(bundle, cast(frame_start + 1 as int), cast(frame_bytes as int))")

    def run(batches):
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for frame, spots in zip(batch.column("bytes"), batch.column("spots").to_pylist()):
                data = opener.decompress(frame.as_py())
                yield _batch([
                    _told(*x) for s in spots
                    for x in parse_records(data[s["offset"] : s["offset"] + s["length"]])
                ])

    return archives.select("archive", "bundle").join(frames, "archive").select(
        cut.alias("bytes"), "spots"
    ).mapInArrow(run, _TOLD_SQL)


def export(archives: DataFrame, uri: str) -> DataFrame:
    """Each bundle as a file below ``uri`` (any store that pyarrow opens); archive and its bytes.

    A file appears under its name when it is whole; a repeated task writes the same one.
    """

    def run(batches):
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for name, bundle in zip(batch.column("archive").to_pylist(), batch.column("bundle")):
                draft = f"{folder}/.{name}.{TaskContext.get().taskAttemptId()}"
                with store.open_output_stream(draft) as out:
                    out.write(bundle.as_py())
                store.move(draft, f"{folder}/{name}")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([len(bundle.as_py())], pa.int64())], names=["archive", "n_bytes"]
                )

    return archives.select("archive", "bundle").mapInArrow(run, "archive string, n_bytes bigint")
