"""Files in the shared folder, opened from tasks, and the seekable Zstandard layout both file formats use.

A file is a row of independent frames, then a skippable frame with a seek table: compressed size, size and the low
32 bits of the xxh64 of every frame, as in the public seekable format. Tasks name files by attempt, and only the rows
that Spark commits name files that count, so a lost executor or a repeated task leaves no half-written data in a result.
"""

from __future__ import annotations

import re
import struct
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext

# Fixed values of the seekable format.
SKIPPABLE_TABLE = 0x184D2A5E
SKIPPABLE_INDEX = 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a shared location; every scheme that Arrow knows works, local folders too."""
    if re.match(r"(file:)?/", path):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def attempt_name(folder: str, suffix: str) -> str:
    task = TaskContext.get()
    return f"{folder}/part-{task.partitionId() if task else 0:06d}-{uuid.uuid4().hex}{suffix}"


class FrameWriter:
    """Appends independent frames, then an index of the caller's and the seek table."""

    def __init__(self, path: str, level: int = 3):
        system, name = place(path)
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.out, self.table = system.open_output_stream(name, compression=None), []
        self.packer = zstandard.ZstdCompressor(level=level)

    def frame(self, data: bytes) -> int:
        """Write one frame and return its number."""
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        return len(self.table) - 1

    def close(self, index: bytes = b"") -> None:
        """``index`` goes into a skippable frame of its own, the last entry of the seek table (size 0)."""
        if index:
            self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
            self.table.append((len(index) + 8, 0, xxhash.xxh64_intdigest(index) & 0xFFFFFFFF))
        body = np.array(self.table, "<u4").tobytes() + struct.pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_TABLE, len(body)) + body)
        self.out.close()


class FrameReader:
    """Reads single frames of a file through its seek table, checking every checksum."""

    def __init__(self, path: str):
        system, name = place(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        self.file.seek(size - 9)
        count, kind, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE_MAGIC or not kind & CHECKSUMS:
            raise ValueError(f"{path} has no seek table with checksums")
        self.file.seek(size - 9 - 12 * count)
        self.table = np.frombuffer(self.file.read(12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.table[:, 0])))
        self.unpacker = zstandard.ZstdDecompressor()

    def _raw(self, number: int) -> bytes:
        self.file.seek(int(self.starts[number]))
        return self.file.read(int(self.table[number, 0]))

    def _checked(self, number: int, data: bytes) -> bytes:
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.table[number, 2]:
            raise ValueError(f"frame {number} is damaged")
        return data

    def frame(self, number: int) -> bytes:
        size = int(self.table[number, 1])
        return self._checked(number, self.unpacker.decompress(self._raw(number), max_output_size=size) if size else b"")

    def index(self) -> bytes:
        return self._checked(len(self.table) - 1, self._raw(len(self.table) - 1)[8:])

    def __enter__(self) -> FrameReader:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def arrow_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())


def arrow_table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()
