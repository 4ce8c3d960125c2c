"""Token ids as binary files: independent Zstandard frames, a document index, and a seek table with a checksum per frame.

The documents are range-sorted by id, every sort partition becomes one file, and the order of the files is the order of the ids. A
frame holds whole documents up to about ``FRAME_IDS`` ids (a longer document fills a frame alone), as little-endian
unsigned 32-bit integers. The index of a file (document ids, frame, place and number of ids) is an Arrow stream in a skippable
frame, so a reader of one document reads the tail of a file and one frame.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from celltrace.llm.encoders import encoder
from celltrace.llm.files import FrameReader, FrameWriter, arrow_bytes, arrow_table, attempt_name
from celltrace.llm.scratch import Scratch

FRAME_IDS = 1 << 16
_ROWS = 1024


def copied(column: pa.Array) -> pa.Array:
    """The column in buffers of its own; a received batch lies in one buffer, so its ids alone would hold its texts as well."""
    return column.take(pa.array(np.arange(len(column))))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 1, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all texts of ``docs`` below ``folder`` and return ``(file, part, documents, tokens, base)``, one row per file:
    ``base`` is the number of ids in the files before it.

    Null texts count as empty; ``end_id`` closes every document (None: nothing). Null ids come first; rows of the
    same id stand in the order of a hash of their texts. The rows come from a written table, so they only name
    files of tasks that Spark has committed.
    """
    kind = docs.schema[id_column].dataType
    id_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, writer, tool = attempt_name(folder, ".tok.zst"), None, encoder(tokenizer)
        index, frames, places, counts, held, total = [], [], [], [], [], 0
        size = 0
        close = np.empty(0, "<u4") if end_id is None else np.array([end_id], "<u4")

        def flush() -> None:
            nonlocal held, size
            if held:
                writer.frame(b"".join(held))
                held, size = [], 0

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                writer = writer or FrameWriter(path)
                ids, offsets = tool.encode_column(part.column(1))
                ids = ids.astype("<u4", copy=False)
                index.append(copied(part.column(0)))
                for first, last in zip(offsets[:-1], offsets[1:]):
                    count = int(last - first) + len(close)
                    if size and size + count > FRAME_IDS:
                        flush()
                    frames.append(len(writer.table))
                    places.append(size)
                    counts.append(count)
                    held.append(ids[first:last].tobytes() + close.tobytes())
                    size += count
                    total += count
        if writer is None:
            return
        flush()
        table = pa.RecordBatch.from_arrays(
            [pa.chunked_array(index, id_type).combine_chunks(), pa.array(frames, pa.int64()), pa.array(places, pa.int64()), pa.array(counts, pa.int64())],
            ["id", "frame", "place", "count"],
        )
        writer.close(arrow_bytes(table))
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([len(counts)]), pa.array([total])], ["file", "part", "documents", "tokens"])

    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).repartitionByRange("id", "hash").sortWithinPartitions("id", "hash").drop("hash")
    files = Scratch(docs.sparkSession, folder).cut(rows.mapInArrow(run, "file string, part int, documents long, tokens long"), "files")
    # one row per file
    return files.withColumn("base", F.coalesce(F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def read_index(path: str) -> pa.Table:
    """The documents of a file: id, frame, place in the frame, number of ids."""
    with FrameReader(path) as file:
        return arrow_table(file.index())


def read_documents(path: str, rows: list[int]) -> list[np.ndarray]:
    """Ids of some documents of a file, by their place in its index; only their frames are read."""
    with FrameReader(path) as file:
        index, frames, out = arrow_table(file.index()), {}, []
        for row in rows:
            frame, place, count = (index[name][row].as_py() for name in ("frame", "place", "count"))
            if frame not in frames:
                frames[frame] = np.frombuffer(file.frame(frame), "<u4")
            out.append(frames[frame][place : place + count])
        return out


def read_token_files(files: DataFrame, id_type: T.DataType, id_column: str = "doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` per document, read back from the files of ``write_token_files``."""
    schema = T.StructType(
        [T.StructField(id_column, id_type), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    )
    arrow_type = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with FrameReader(path) as file:
                    index = arrow_table(file.index())
                    counts, frames, places = (index[name].to_numpy() for name in ("count", "frame", "place"))
                    current, data, sums = -1, b"", np.empty(len(counts), np.int64)
                    for row, (frame, place, count) in enumerate(zip(frames.tolist(), places.tolist(), counts.tolist())):
                        if frame != current:
                            current, data = frame, memoryview(file.frame(frame))
                        sums[row] = zlib.crc32(data[4 * place : 4 * (place + count)])
                starts = base + np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays([index["id"].combine_chunks().cast(arrow_type), pa.array(starts), pa.array(counts), pa.array(sums)], schema.names)

    spread = files.select("file", "base").repartition(max(1, files.count()))  # one task per file
    return spread.mapInArrow(run, schema)


def token_table(docs: DataFrame, tokenizer: str, end_id: int | None = 1, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the token files of ``docs`` into the shared folder and read them back: ``(id, start, n_tokens, ids_crc32)``."""
    folder = Scratch(docs.sparkSession).path("tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id, id_column, text), docs.schema[id_column].dataType, id_column)
