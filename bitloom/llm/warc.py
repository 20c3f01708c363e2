"""WARC archives with a Zstandard dictionary, written and read in parallel.

Each file is one task's: a skippable frame (magic 0x184D2A5D) that holds the
dictionary built from that file's own records, then every record compressed as
a frame of its own, so a record can be read without its neighbours.  Files go
through Spark's text writer, whose committer makes a retried task's file count
once, onto any file system that Spark knows: the bytes pass as a string, and the
line separator is itself an empty skippable frame, which every reader skips.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .spill import fresh_path, tune

DICTIONARY_MAGIC = struct.pack("<I", 0x184D2A5D)
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
SKIPPABLE = {struct.pack("<I", 0x184D2A50 + k) for k in range(16)}
FRAME_MAGIC = struct.pack("<I", 0xFD2FB528)


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _line(value: str) -> str:
    """A header's value: control characters would end it."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    """One record; ``first`` names the response that it revisits, or is None."""
    name = "" if page_id is None else page_id
    headers = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>", f"WARC-Date: {date}"]
    if url is not None:
        headers.append(f"WARC-Target-URI: {_line(url)}")
    headers += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if first is None:
        block = http + payload
    else:
        headers += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{first}>"]
        block = http
    headers += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the records' own bytes where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, records, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-size:]


def _opened(data: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else zstandard.ZstdCompressionDict(data + b"\0" * (8 - len(data)))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit: int = 0,
                   date: str = "1970-01-01T00:00:00Z", dictionary: int = 64 << 10, training: int = 4 << 20, level: int = 3) -> None:
    """Write a record for each page under ``path``, one ``.warc.zst`` part a task.

    Payloads are the html in UTF-8; a null one is empty.  Of records with equal
    payloads of at least ``min_revisit`` bytes the one with the smallest id is
    the response and the others revisit it; rows that repeat that id and payload
    are responses too.  Null ids come last: a payload that only they have makes
    responses of them all.  Null urls get no Target-URI.  Columns of other names
    are not archived.

    ``training``: a file's dictionary is built from about so many bytes of its
    first records, so a task holds no more of them; the rest is streamed.
    """
    tune(pages.sparkSession)
    html = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), html.alias("payload"), F.sha1(html).alias("sha1"), F.octet_length(html).alias("n"))
    # Only payloads that occur again need to be known elsewhere.
    again = rows.where(F.col("n") >= min_revisit).groupBy("sha1").agg(F.min("id").alias("first"), F.count("*").alias("k")).where("k > 1").select("sha1", "first")
    typed = rows.join(again, "sha1", "left").select("id", "url", "payload", "sha1", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[bytes] = []
        held, press, out, size = 0, None, [], 0

        def frame(data: bytes) -> bytes:
            return press.compress(data)

        def start() -> bytes:
            nonlocal press
            trained = build_dictionary(waiting, dictionary)
            press = zstandard.ZstdCompressor(level=level, dict_data=_opened(trained))
            return DICTIONARY_MAGIC + struct.pack("<I", len(trained)) + trained

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                record = record_bytes(row[0], row[1], row[2], base32(row[3]), row[4], date)
                if press is None:
                    waiting.append(record)
                    held += len(record)
                    if held < training:
                        continue
                    out = [start(), *map(frame, waiting)]
                    waiting = []
                else:
                    out.append(frame(record))
                size += len(out[-1])
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                    out, size = [], 0
        if waiting:
            out = [start(), *map(frame, waiting)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    packed = typed.mapInArrow(pack, "value binary").select(F.col("value").cast("string"))
    packed.write.option("lineSep", EMPTY_FRAME).text(path)


def records_of(data: bytes) -> Iterator[bytes]:
    """The records of one archive file, each decompressed by itself."""
    at, open_ = 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic = data[at : at + 4]
        if magic in SKIPPABLE:
            (n,) = struct.unpack("<I", data[at + 4 : at + 8])
            if magic == DICTIONARY_MAGIC:
                open_ = zstandard.ZstdDecompressor(dict_data=_opened(data[at + 8 : at + 8 + n]))
            at += 8 + n
        elif magic == FRAME_MAGIC:
            reader = open_.decompressobj()
            window = 1 << 16
            got = [reader.decompress(data[at : at + window])]
            end = at + window
            while not reader.eof and end < len(data):
                got.append(reader.decompress(data[end : end + window]))
                end += window
            if not reader.eof:
                raise ValueError(f"the frame at byte {at} is cut off")
            at = min(end, len(data)) - len(reader.unused_data)
            yield b"".join(got)
        else:
            raise ValueError(f"no frame at byte {at}")


def parse_record(record: bytes) -> dict:
    """Headers by name, ``id`` and ``refers_to``, and the ``payload`` of a response, whose digest is checked."""
    head, _, block = record.partition(b"\r\n\r\n")
    headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[: int(headers["Content-Length"])]
    name = lambda key: (v := headers[key][len("<urn:page:") : -1]) and int(v) if key in headers else None
    out = {"headers": headers, "id": name("WARC-Record-ID"), "refers_to": name("WARC-Refers-To"), "type": headers["WARC-Type"]}
    out["id"] = None if out["id"] == "" else out["id"]
    if out["type"] == "response":
        import hashlib

        out["payload"] = block.partition(b"\r\n\r\n")[2]
        if headers["WARC-Payload-Digest"] != f"sha1:{base64.b32encode(hashlib.sha1(out['payload']).digest()).decode()}":
            raise ValueError(f"digest of record {out['id']} doesn't hold")
    return out


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """A row for each record under ``path``: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and payload if asked for (null for revisits)."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows: list[tuple] = []
                held = 0
                for record in records_of(data.as_py()):
                    r = parse_record(record)
                    h = r["headers"]
                    row = (r["id"], h.get("WARC-Target-URI"), int(h["X-Payload-Length"]), h["WARC-Payload-Digest"].removeprefix("sha1:"), r["type"], r["refers_to"])
                    rows.append((*row, r.get("payload")) if payload else row)
                    held += len(record)
                    if held > 16 << 20:
                        yield table(rows)
                        rows, held = [], 0
                if rows:
                    yield table(rows)

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in READ.split(", ")] + ["payload"]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names[: len(rows[0])])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(unpack, READ + ", payload binary" * payload)


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """Archive the pages in the shared folder and read the archives back."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path, **how)
    return read_archives(pages.sparkSession, path)
