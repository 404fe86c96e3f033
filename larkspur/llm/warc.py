"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames, frames into bundles; a bundle ends with a seek table (a
skippable frame with the sizes of all frames), and an index maps each record's id to its frame and
its place in the decompressed frame, so one record is read by decompressing one frame.  Bundles are
rows of a Parquet table, so writing and reading them is Spark's work wherever the table is.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialize

# Fixed values of the seekable format.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
FRAME_BYTES, BUNDLE_BYTES = 128 << 10, 4 << 20
#: Payloads of fewer bytes are always stored.
LEAST_REVISIT = 1000
#: Broadcast the table of repeated payloads while it has at most so many rows (a digest and two numbers each).
BROADCAST_REPEATED = 200_000
#: Beyond that it is joined by digest, and the pages of a digest are dealt over so many tasks.
SALTS = 16
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BUNDLE = "bundle string, content binary, entries array<struct<record_id:string,frame:int,offset:bigint,length:bigint>>"
_ENTRY = pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())])


def record_id(page_id: object) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(text: str) -> int | None:
    return int(text[10:-1]) if text[10:-1] else None


def record(page_id: object, url: str | None, payload: bytes, digest: str, refers_to: object, date: str) -> bytes:
    """A response with its payload, or a revisit (`refers_to` given) without."""
    block = _HTTP if refers_to is not None else _HTTP + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes, offset: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and end of the record at an offset of a decompressed frame."""
    head = data.index(b"\r\n\r\n", offset)
    first, *lines = data[offset:head].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no record at {offset}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    end = head + 4 + int(headers["Content-Length"])
    block = data[head + 4 : end]
    return headers, block[block.index(b"\r\n\r\n") + 4 :], end + 4


class Bundle:
    """Frames of records, written one after the other."""

    def __init__(self, level: int, frame_bytes: int = FRAME_BYTES):
        self.zstd, self.frame_bytes = zstandard.ZstdCompressor(level=level, write_checksum=True), frame_bytes
        self.frames, self.sizes, self.entries, self.raw = [], [], [], []

    def add(self, name: str, data: bytes) -> None:
        at = sum(map(len, self.raw))
        self.entries.append((name, len(self.frames), at, len(data)))
        self.raw.append(data)
        if at + len(data) >= self.frame_bytes:
            self._flush()

    def _flush(self) -> None:
        if self.raw:
            data = b"".join(self.raw)
            self.frames.append(self.zstd.compress(data))
            self.sizes.append((len(self.frames[-1]), len(data)))
            self.raw = []

    def size(self) -> int:
        return sum(map(len, self.frames))

    def content(self) -> bytes:
        self._flush()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, _SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", _SKIPPABLE, len(table)) + table


def frame_places(content: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, size) of each frame, from the seek table at the end."""
    n, flags, magic = struct.unpack("<IBI", content[-9:])
    if magic != _SEEKABLE:
        raise ValueError("no seek table")
    width, start, out = (12 if flags & 0x80 else 8), 0, []
    table = content[len(content) - 9 - n * width : -9]
    for k in range(n):
        packed, size = struct.unpack_from("<II", table, k * width)
        out.append((start, packed, size))
        start += packed
    return out


def read_frame(content: bytes, frame: int) -> bytes:
    start, packed, size = frame_places(content)[frame]
    return zstandard.ZstdDecompressor().decompress(content[start : start + packed], max_output_size=size)


def picked(content: bytes, places: list[tuple[int, int]]) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records at (frame, offset) of a bundle; each frame that holds one is decompressed once."""
    for frame, of_frame in groupby(sorted(places), key=lambda p: p[0]):
        data = read_frame(content, frame)
        for _, offset in of_frame:
            headers, payload, _ = parsed(data, offset)
            yield headers, payload


def _with_digests(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    return rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "n": F.octet_length("html").cast("long")})


def repeated_payloads(rows: DataFrame) -> DataFrame:
    """(digest, n, largest): the payloads of LEAST_REVISIT bytes or more that two rows or more have, with
    the largest id of these rows; none where all ids are null.  Counts combine before the shuffle."""
    groups = rows.where(F.col("n") >= LEAST_REVISIT).groupBy("digest", "n").agg(F.max("id").alias("largest"), F.count("*").alias("copies"))
    return groups.where("copies > 1 and largest is not null").select("digest", "n", "largest")


def _marked(rows: DataFrame) -> DataFrame:
    """The rows with refers_to, by payload, so that repeated and null ids are told apart."""
    repeated = materialize(repeated_payloads(rows), "repeated")
    on = ["digest", "n"]
    if repeated.count() <= BROADCAST_REPEATED:
        rows = rows.join(F.broadcast(repeated), on, "left")
    else:
        salts = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
        rows = salted.join(salts, [*on, "salt"], "left")
    return rows.withColumn("refers_to", F.when(~F.col("id").eqNullSafe(F.col("largest")), F.col("largest")))


def archived(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    level: int = 3,
    date: str = "2024-01-01T00:00:00Z",
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Bundles (bundle, content, entries) with one record per page.

    A null html is an empty payload.  Of the pages with one payload of LEAST_REVISIT bytes or more
    those with the largest id are responses and the others, those with null ids too, revisit it; if
    all their ids are null, all are responses.  Repeated ids may have different payloads.
    """
    rows = _marked(_with_digests(pages, id_col, url_col, html_col)).select("id", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bundle, n = Bundle(level, frame_bytes), 0
        name = f"part-{TaskContext.get().partitionId():06d}"

        def done() -> pa.RecordBatch:
            entries = [dict(zip(("record_id", "frame", "offset", "length"), e)) for e in bundle.entries]
            columns = [pa.array([f"{name}-{n:05d}.warc.zst"]), pa.array([bundle.content()], pa.binary()), pa.array([entries], pa.list_(_ENTRY))]
            return pa.RecordBatch.from_arrays(columns, ["bundle", "content", "entries"])

        for b in batches:
            for page, url, html, refers in zip(*(c.to_pylist() for c in b.columns)):
                payload = html.encode("utf-8", "surrogatepass")
                bundle.add(record_id(page), record(page, url, payload, hashlib.sha1(payload).hexdigest(), refers, date))
                if bundle.size() >= bundle_bytes:
                    yield done()
                    bundle, n = Bundle(level, frame_bytes), n + 1
        if bundle.entries:
            yield done()

    return rows.mapInArrow(run, BUNDLE)


def _row(headers: dict[str, str], payload: bytes) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to; raises on a damaged response."""
    digest, n, kind = headers["WARC-Payload-Digest"][5:], int(headers["X-Payload-Length"]), headers["WARC-Type"]
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != n):
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    refers = page_of(headers["WARC-Refers-To"]) if "WARC-Refers-To" in headers else None
    return page_of(headers["WARC-Record-ID"]), headers["WARC-Target-URI"], n, digest, kind, refers


ROW = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
_NAMES = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
_KINDS = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]


def read_back(bundles: DataFrame) -> DataFrame:
    """One row per record of the bundles (column content), read frame by frame: see ROW.

    Raises on a stored payload that does not have its digest or length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                content, unzip = content.as_py(), zstandard.ZstdDecompressor()
                for start, packed, size in frame_places(content):
                    data, at, rows = unzip.decompress(content[start : start + packed], max_output_size=size), 0, []
                    while at < len(data):
                        headers, payload, at = parsed(data, at)
                        rows.append(_row(headers, payload))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _NAMES)

    return bundles.select("content").mapInArrow(run, ROW)


def read_records(bundles: DataFrame, ids: DataFrame, id_col: str = "page_id") -> DataFrame:
    """The records of the asked ids by the index: see ROW, and payload (null for a revisit).

    Only the index is searched, only the bundles with an asked id are opened, and of these only the
    frames that hold one are decompressed.  A null id asks for the pages without id; an id asked
    twice is answered once; an id that several pages have gives all of them; unknown ones give nothing.
    """
    asked = ids.select(F.concat(F.lit("<urn:page:"), F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")), F.lit(">")).alias("record_id")).distinct()
    places = bundles.select("bundle", F.explode("entries").alias("e")).select("bundle", "e.record_id", "e.frame", "e.offset").join(asked, "record_id", "left_semi")
    # a bundle's index is bounded by its size, so its places may stand in one row
    places = places.groupBy("bundle").agg(F.collect_list(F.struct("frame", "offset")).alias("places"))
    rows = bundles.select("bundle", "content").join(places, "bundle").select("content", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content, places in zip(b.column(0), b.column(1)):
                found = list(picked(content.as_py(), [(p["frame"], p["offset"]) for p in places.as_py()]))
                columns = [pa.array(c, k) for c, k in zip(zip(*(_row(*x) for x in found)), _KINDS)]
                payloads = pa.array([p if h["WARC-Type"] == "response" else None for h, p in found], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, payloads], [*_NAMES, "payload"])

    return rows.mapInArrow(run, f"{ROW}, payload binary")
