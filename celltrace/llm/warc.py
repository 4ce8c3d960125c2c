"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames of about ``FRAME_BYTES`` bytes (a larger record fills a frame alone), and a
seek table with a checksum per frame closes the file. The index maps every record to its file, its frame and the offset inside
the decompressed frame, so one record costs one read of the tail and one frame.

Of the records with equal payloads the one with the largest id is the response; the others are revisits, which hold the HTTP
header only and name the response. The header's Content-Length and the payload digest still speak of the full payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltrace.llm.files import FrameReader, FrameWriter, attempt_name
from celltrace.llm.scratch import Scratch

FRAME_BYTES = 1 << 18
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
INDEX = "id string, record_id string, record_type string, file string, frame long, offset long, length long"
RECORD = "id string, url string, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(name: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{name}/{digest}')}>"


def _header(fields: list[tuple[str, str | None]]) -> bytes:
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields if v is not None), "\r\n"]).encode()


def record(name: str | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: str | None) -> bytes:
    """A response, or a revisit if ``payload`` is None. Control characters of a URL are percent-encoded."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")
    revisit = payload is None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(name, digest)), ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, digest) if revisit else None), ("Page-ID", None if name is None else quote(name)), ("Refers-To-Page-ID", quote(refers_to) if revisit else None),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block))),
    ]
    return _header(fields) + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header, block and end of the record at a place of a decompressed frame."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    header = dict(line.split(": ", 1) for line in lines[1:])
    end = stop + 4 + int(header["Content-Length"])
    return header, data[stop + 4 : end], end + 4


def _fields(header: dict[str, str], block: bytes) -> tuple:
    """A row of ``RECORD``; a response whose payload does not have its digest is refused."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = header["WARC-Payload-Digest"].removeprefix("sha1:"), header["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {header['WARC-Record-ID']} is damaged")
    name, first = (unquote(header[k]) if k in header else None for k in ("Page-ID", "Refers-To-Page-ID"))
    return name, header.get("WARC-Target-URI"), header["WARC-Record-ID"], kind, size, digest, first, payload if kind == "response" else None


def with_roles(pages: DataFrame, id_column: str, url: str, html: str, min_bytes: int) -> DataFrame:
    """``(id, url, payload, first)``: ``first`` is the id of the response that a row revisits, null for responses."""
    rows = pages.select(F.col(id_column).alias("id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    # only digests that come twice move on; a hot one is counted before the shuffle
    same = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null")
    joined = rows.join(same.drop("n"), "digest", "left")
    first = F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first"))
    first = F.when(F.octet_length("payload") >= min_bytes, first)
    return joined.select(F.col("id").cast("string"), "url", "payload", first.cast("string").alias("first"))


def write_archives(pages: DataFrame, folder: str, id_column: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write one record per row of ``pages`` and return the index ``INDEX``, a written table.

    Payloads of fewer than ``min_bytes`` bytes are never revisits. Null payloads are empty; null ids are never named by a
    revisit unless a whole group has none, which then are all responses; rows that share the largest id of a group are all responses.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, writer, held, size, rows = attempt_name(folder, ".warc.zst"), None, [], 0, []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size, rows
            if held:
                frame = writer.frame(b"".join(held))
                columns = list(zip(*((n, r, k, path, frame, o, s) for n, r, k, o, s in rows)))
                held, size, rows = [], 0, []
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.string()] * 4 + [pa.int64()] * 3)], ["id", "record_id", "record_type", "file", "frame", "offset", "length"])

        for batch in batches:
            names, urls, firsts = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for i, (name, address, first) in enumerate(zip(names, urls, firsts)):
                if writer is None:
                    writer = FrameWriter(path)
                    info = b"software: celltrace\r\nformat: WARC File Format 1.1\r\n"
                    writer.frame(_header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_SPACE, path)}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(info)))]) + info + b"\r\n\r\n")
                payload = batch.column(2)[i].as_buffer().to_pybytes()
                digest = base32_sha1(payload)
                data = record(name, address, payload if first is None else None, len(payload), digest, first)
                if size and size + len(data) > FRAME_BYTES:
                    yield from flush()
                rows.append((name, record_id(name, digest), "response" if first is None else "revisit", size, len(data)))
                held.append(data)
                size += len(data)
        if writer is not None:
            yield from flush()
            writer.close()

    rows = with_roles(pages, id_column, url, html, min_bytes)
    return Scratch(pages.sparkSession, folder).cut(rows.mapInArrow(run, INDEX), "index")


def read_record(path: str, frame: int, offset: int) -> tuple:
    """One record by its place in the index, as a row of ``RECORD``."""
    with FrameReader(path) as file:
        header, block, _ = parse(file.frame(frame), offset)
    return _fields(header, block)


def read_archives(index: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the archives that ``index`` names, as ``RECORD``; without ``payloads`` that column is null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string()] * 4 + [pa.int64()] + [pa.string()] * 2 + [pa.binary()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with FrameReader(path) as file:
                    for number in range(1, len(file.table)):
                        data, at, rows = file.frame(number), 0, []
                        while at < len(data):
                            header, block, at = parse(data, at)
                            fields = _fields(header, block)
                            rows.append(fields if payloads else (*fields[:-1], None))
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [f.split()[0] for f in RECORD.split(", ")])

    files = index.select("file").distinct()
    return files.repartition(max(1, files.count())).mapInArrow(run, RECORD)


def archive_report(pages: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Archive all pages in the shared folder, read the archives back: ``(id, payload_bytes, payload_digest, record_type, refers_to)``."""
    kind = pages.schema[id_column].dataType
    index = write_archives(pages, Scratch(pages.sparkSession).path("warc"), id_column, url, html, min_bytes)
    found = read_archives(index, payloads=False)
    return found.select(F.col("id").cast(kind).alias(id_column), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
