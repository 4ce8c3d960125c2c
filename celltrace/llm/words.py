"""Words and word shingles of whole texts as 64-bit hashes, computed on Arrow buffers.

A word is a run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; A-Z counts as a-z. Words are hashed side by side, eight bytes at a
time, so no Python object is made per word unless it is a long one. Slices are cut at white space and bound the memory that a text of any length needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_SLICE = 1 << 18
#: Ranges of more bytes are hashed one by one.
_LONG = 64
_BREAKS = np.zeros(256, bool)
_BREAKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32


def mix(z: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 64-bit numbers, in place."""
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task holds and sends back at once stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the row offsets into them; null rows have no bytes."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64, len(column) + 1, column.offset * 8)
    raw = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Begin and end of slices that are cut at white space or between texts, and the places inside where a text begins.

    A slice is longer than ``_SLICE`` bytes only for a single word that is.
    """
    at, size = 0, len(raw)
    while at < size:
        end = min(size, at + _SLICE)
        if end < size and end not in offsets[[np.searchsorted(offsets, end)]]:
            blanks = np.flatnonzero(_BREAKS[raw[at:end]])
            cut = max(offsets[np.searchsorted(offsets, end, "right") - 1], at + blanks[-1] + 1 if len(blanks) else at)
            if cut <= at:  # one long word: up to its end
                cut, limit = end, offsets[np.searchsorted(offsets, end, "right")]
                while cut < limit and not (stop := np.flatnonzero(_BREAKS[raw[cut : min(limit, cut + _SLICE)]])).size:
                    cut = min(limit, cut + _SLICE)
                cut += stop[0] if cut < limit else 0
            end = int(cut)
        inner = offsets[np.searchsorted(offsets, at, "left") : np.searchsorted(offsets, end, "left")]
        yield at, end, np.unique(inner) - at
        at = end


def bounds(raw: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of one slice."""
    inside = ~_BREAKS[raw]
    before = np.empty(len(raw), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[firsts] = False
    closes = np.empty(len(raw), bool)
    closes[-1] = True
    closes[:-1] = ~inside[1:]
    closes[firsts[firsts > 0] - 1] = True
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & closes) + 1


def lanes(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of ``raw`` on as one number; zeros follow the end."""
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    return np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))


def first_bytes(lane: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Lanes without the bytes behind the first ``count`` (1 or more) ones."""
    drop = np.maximum(8 - count, 0).astype(np.uint64) * np.uint64(8)
    return (lane << drop) >> drop


def range_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """Hash of every byte range of a slice, A-Z as a-z with ``fold``.

    Eight bytes at a time, each step a permutation of the state, so ranges of up to eight bytes never share a hash with
    another one of their length; longer ranges than ``_LONG`` go through XXH3.
    """
    raw = FOLD[raw] if fold else raw
    sizes, view = ends - starts, lanes(raw)
    out, todo = sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), np.flatnonzero((sizes > 0) & (sizes <= _LONG))
    for at in range(0, _LONG, 8):
        if at:
            todo = todo[sizes[todo] > at]
        if not len(todo):
            break
        z = out[todo] ^ first_bytes(view[starts[todo] + at], sizes[todo] - at)
        z *= np.uint64(0x9E3779B97F4A7C15)
        out[todo] = mix(z)
    for i in np.flatnonzero(sizes > _LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : ends[i]].tobytes(), 0x5D)
    return out


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all rows, and the offset of every row's first word."""
    places, values = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for at, end, firsts in slices(raw, offsets):
        starts, ends = bounds(raw[at:end], firsts)
        places.append(starts + at)
        values.append(range_hashes(raw[at:end], starts, ends))
    places = np.concatenate(places)
    return np.concatenate(values), np.searchsorted(places, offsets, "left")


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words, in order; a shorter text is one run of all its words."""
    if not len(words):
        return np.empty(0, np.uint64)
    width = min(width, len(words))
    count = len(words) - width + 1
    z = words[:count].copy()
    for k in range(1, width):
        z *= np.uint64(0x9FB21C651E98DF25)
        z += words[k : k + count]
        z ^= z >> np.uint64(32)
    return mix(z + np.uint64(width))
