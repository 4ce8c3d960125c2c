"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Plain MinHash estimates Jaccard similarity, which vanishes when a short item lies in a long document. So both sides are
partitioned by size: items by the power of two ``u`` that covers their shingles, documents into overlapping windows
of ``2 * u`` shingles for every such class. Inside a class, containment of 80 % then means a Jaccard similarity of
about 0.2 at least, and the class takes as many coordinates as bring the chance of a miss below ``MISS``. A
window whose coordinate equals an item's makes a candidate, which counts only if the full shingle sets agree.

The items are the stated query set. They are searched in slices of bounded size, each sent to all executors; every document
is read whole, and nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltrace.llm import words

#: Chance that an item at the threshold inside one window shares no coordinate with it.
MISS = 1e-6
#: Shingles of one slice of items: 8 bytes each, and at most 80 coordinates of 12 bytes per item.
SLICE_SHINGLES = 1 << 20
_CELLS = 1 << 20


def coordinates(size_class: int, percent: int) -> int:
    """Coordinates for items of ``(size_class / 2, size_class]`` shingles against windows of twice that size."""
    least = 1.0
    for q in range(size_class // 2 + 1, size_class + 1):
        shared = -(-percent * q // 100)
        least = min(least, shared / ((2 * size_class if size_class > 1 else 1) + q - shared))
    return 1 if least == 1 else math.ceil(math.log(MISS) / math.log1p(-least))


def _hashes(items: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash values of every shingle: one permutation, then a second one shifted once more per value."""
    z = words.mix(items ^ np.uint64(0x2545F4914F6CDD1D))[:, None] + np.arange(1, count + 1, dtype=np.uint64)
    z ^= z >> np.uint64(33)
    z *= np.uint64(0xFF51AFD7ED558CCD)
    z ^= z >> np.uint64(29)
    z *= np.uint64(0xC4CEB9FE1A85EC53)
    return z


def _block_minima(items: np.ndarray, block: int, count: int) -> np.ndarray:
    """Smallest values of every run of ``block`` shingles, the last one shorter."""
    step = max(1, _CELLS // (count * block)) * block
    parts = [
        np.minimum.reduceat(_hashes(items[at : at + step], count), np.arange(0, len(items[at : at + step]), block), axis=0)
        for at in range(0, len(items), step)
    ]
    return np.concatenate(parts)


class ItemIndex:
    """A slice of items: shingle sets, and per size class the coordinates of its items."""

    def __init__(self, ids: list, texts: list[str | None], width: int, percent: int):
        self.width, self.percent, self.ids, self.sets, self.classes = width, percent, [], [], {}
        raw, offsets = words.text_buffers(pa.array(texts, pa.string()))
        hashes, firsts = words.word_hashes(raw, offsets)
        groups: dict[int, list[int]] = {}
        for name, first, last in zip(ids, firsts[:-1], firsts[1:]):
            if last > first:
                items = np.unique(words.shingles(hashes[first:last], width))
                groups.setdefault(1 << (len(items) - 1).bit_length(), []).append(len(self.ids))
                self.ids.append(name)
                self.sets.append(items)
        for size_class, members in groups.items():
            count = coordinates(size_class, percent)
            values = np.stack([_hashes(self.sets[i], count).min(axis=0) for i in members])
            flat, owners = values.ravel(), np.repeat(np.array(members), count)
            flat = flat ^ words.mix(np.tile(np.arange(count, dtype=np.uint64), len(members)))  # tells coordinates apart
            order = np.argsort(flat, kind="stable")
            known = np.zeros(1 << 20, bool)
            known[(flat & np.uint64(0xFFFFF)).astype(np.int64)] = True
            self.classes[size_class] = (count, flat[order], owners[order], known)

    def search(self, hashes: np.ndarray) -> list[tuple[int, int]]:
        """Items held by the text with these word hashes: place of the item and number of shared shingles."""
        found, candidates, minima, block = [], set(), None, 0
        if not len(hashes) or not self.classes:
            return found
        items = words.shingles(hashes, self.width)
        count_all = max(count for count, *_ in self.classes.values())
        for size_class in sorted(self.classes):
            if minima is None:
                minima, block = _block_minima(items, size_class, count_all), size_class
            while block < size_class:
                minima, block = np.minimum.reduceat(minima, np.arange(0, len(minima), 2), axis=0), block * 2
            count, values, owners, known = self.classes[size_class]
            windows = np.minimum(minima[:-1, :count], minima[1:, :count]) if len(minima) > 1 and size_class > 1 else minima[:, :count]
            keys = windows ^ words.mix(np.arange(count, dtype=np.uint64))
            keys = np.unique(keys[known[(keys & np.uint64(0xFFFFF)).astype(np.int64)]])
            low, high = np.searchsorted(values, keys, "left"), np.searchsorted(values, keys, "right")
            for a, b in zip(low[high > low], high[high > low]):
                candidates.update(owners[a:b].tolist())
        if candidates:
            items = np.unique(items)
            for i in sorted(candidates):
                wanted = self.sets[i]
                places = np.minimum(np.searchsorted(items, wanted), len(items) - 1)
                shared = int((items[places] == wanted).sum())
                if 100 * shared >= self.percent * len(wanted):
                    found.append((i, shared))
        return found

    def rows(self, column: pa.Array) -> Iterator[list[tuple[int, int]]]:
        for at in range(0, len(column), 512):
            raw, offsets = words.text_buffers(column.slice(at, 512))
            hashes, firsts = words.word_hashes(raw, offsets)
            for first, last in zip(firsts[:-1], firsts[1:]):
                yield self.search(hashes[first:last])


def slices(items: DataFrame, id_column: str, text: str, width: int, percent: int) -> Iterator[ItemIndex]:
    """The items as indexes of at most ``SLICE_SHINGLES`` words each (a longer item alone)."""
    ids, texts, held = [], [], 0
    for name, value in items.select(F.col(id_column), F.col(text).cast("string")).toLocalIterator():
        size = len(value.split()) if value else 0
        if ids and held + size > SLICE_SHINGLES:
            yield ItemIndex(ids, texts, width, percent)
            ids, texts, held = [], [], 0
        ids.append(name)
        texts.append(value)
        held += size
    if ids:
        yield ItemIndex(ids, texts, width, percent)


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    item_text: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``(id, item id, n_shingles, n_shared, containment)`` for every item held by a row of ``docs``.

    An item is held if ``100 * n_shared >= percent * n_shingles`` over distinct ``width``-word shingles. A text of fewer
    words is one shingle of all its words, on both sides: so an item below the width is held only by a document that is the item, word by
    word, and a word or two inside a long text are no match. Null and empty texts hold nothing and are held by nothing;
    repeated rows and items are reported each.
    """
    spark = docs.sparkSession
    schema = T.StructType(
        [
            T.StructField(id_column, docs.schema[id_column].dataType), T.StructField(item_id, items.schema[item_id].dataType),
            T.StructField("n_shingles", T.LongType()), T.StructField("n_shared", T.LongType()), T.StructField("containment", T.DoubleType()),
        ]
    )
    wanted = docs.select(F.col(id_column), F.col(text).cast("string"))
    out = None
    for index in slices(items, item_id, item_text, width, percent):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in words.small(batches):
                rows, places, shared = [], [], []
                for row, hits in enumerate(index.rows(batch.column(1))):
                    for place, count in hits:
                        rows.append(row)
                        places.append(place)
                        shared.append(count)
                sizes = [len(index.sets[i]) for i in places]
                columns = [
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array([index.ids[i] for i in places]).cast(id_type),
                    pa.array(sizes, pa.int64()), pa.array(shared, pa.int64()), pa.array([a / b for a, b in zip(shared, sizes)], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

        from pyspark.sql.pandas.types import to_arrow_type

        id_type = to_arrow_type(items.schema[item_id].dataType)
        part = wanted.mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return out if out is not None else spark.createDataFrame([], schema)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` whose text holds no item, with all their columns; null and empty texts stay."""
    spark, out = docs.sparkSession, docs
    for index in slices(items, item_id, item_text, width, percent):
        sent = spark.sparkContext.broadcast(index)
        place = out.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in words.small(batches):
                column = batch.column(place)
                clean = [not hits for hits in sent.value.rows(column if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.cast(pa.string()))]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(run, out.schema)
    return out
