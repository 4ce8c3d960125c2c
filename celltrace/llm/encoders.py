"""Token ids of whole texts by public tokenizer files, one encoder per worker process."""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa

from celltrace.llm import words

#: Pieces that a worker keeps with their ids; the store starts anew when it is full, which changes no result.
STORED_PIECES = 1 << 19
_SLOTS = 1 << 20

_TAIL = np.zeros(256, bool)  # marks that never join a letter before them
_TAIL[[ord(c) for c in ".,;:!?#$%&*|"]] = True
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True


def _splits_at_space(spec: dict) -> bool:
    """Whether blanks and line ends only ever separate words for this tokenizer, so words can be encoded one by one."""
    normal, split = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps = normal.get("normalizers", [normal] if normal else [])
    plain = all(s["type"] in ("NFC", "Lowercase") or (s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"} and s["content"] == " ") for s in steps)
    parts = split.get("pretokenizers", [split] if split else [])
    cuts = bool(parts) and parts[0]["type"] == "Split" and parts[0]["behavior"] == "Removed" and parts[0]["invert"] and "\\s\\p{L}\\p{N}]+" in parts[0]["pattern"].get("Regex", "")
    rest = all(p["type"] == "ByteLevel" and not p["add_prefix_space"] and not p["use_regex"] for p in parts[1:])
    marks = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and not set(" \n") & set(t["content"]) for t in spec.get("added_tokens", []))
    return plain and cuts and rest and marks and not spec.get("truncation") and not spec.get("padding")


def _plain_letters(raw: np.ndarray) -> np.ndarray:
    """Bytes of letters that normalisation at most lowers, one to one: ASCII and the Latin-1 ones (``C3 80`` to ``C3 BF``)."""
    lead = raw[:-1] == 0xC3
    lead &= (raw[1:] >= 0x80) & (raw[1:] <= 0xBF) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
    out = _ASCII_LETTER[raw]
    out[:-1] |= lead
    out[1:] |= lead
    return out


class PieceStore:
    """Ids of pieces by the 64-bit hash of their bytes: an open hash table in flat arrays, probed for whole batches. The bytes of a
    piece are kept and compared with those that ask for it."""

    def __init__(self):
        self.text, self.place, self.length, self.filled = np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64), 0
        self.keys, self.rows = np.zeros(_SLOTS, np.uint64), np.full(_SLOTS, -1, np.int32)
        self.first, self.count, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)
        self.size = self.used = 0

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        return array if size <= len(array) else np.concatenate([array, np.empty(max(size, 2 * len(array)) - len(array), array.dtype)])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of every key, -1 for unknown ones."""
        slot = (keys >> np.uint64(20)).astype(np.int64) & (_SLOTS - 1)
        rows = self.rows[slot]
        todo = np.flatnonzero((rows >= 0) & (self.keys[slot] != keys))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (_SLOTS - 1)
            rows[todo] = self.rows[slot[todo]]
            todo = todo[(rows[todo] >= 0) & (self.keys[slot[todo]] != keys[todo])]
        return rows

    def same(self, rows: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether the byte ranges of ``text`` are those of the stored ``rows``."""
        sizes, out = ends - starts, self.length[rows] == ends - starts
        mine, theirs, at = words.lanes(text), words.lanes(self.text[: self.filled]), 0
        todo = np.flatnonzero(out)
        while len(todo) and at < words._LONG:
            left = sizes[todo] - at
            equal = words.first_bytes(mine[starts[todo] + at], left) == words.first_bytes(theirs[self.place[rows[todo]] + at], left)
            out[todo[~equal]] = False
            at += 8
            todo = todo[equal & (left > 8)]
        for i in todo.tolist():
            here, there = starts[i], self.place[rows[i]]
            out[i] = np.array_equal(text[here : ends[i]], self.text[there : there + sizes[i]])
        return out

    def add(self, keys: np.ndarray, pieces: list[bytes], counts: np.ndarray, ids: np.ndarray) -> None:
        """New distinct keys with their bytes, and their ids one after another."""
        rows = np.arange(self.size, self.size + len(keys), dtype=np.int32)
        size, used = self.size + len(keys), self.used + len(ids)
        self.first, self.count, self.ids = self._room(self.first, size), self._room(self.count, size), self._room(self.ids, used)
        text = np.frombuffer(b"".join(pieces), np.uint8)
        self.place, self.length, self.text = self._room(self.place, size), self._room(self.length, size), self._room(self.text, self.filled + len(text))
        self.length[self.size : size] = lengths = np.array([len(p) for p in pieces], np.int64)
        self.place[self.size : size] = self.filled + np.cumsum(lengths) - lengths
        self.text[self.filled : self.filled + len(text)] = text
        self.filled += len(text)
        self.first[self.size : size] = self.used + np.cumsum(counts) - counts
        self.count[self.size : size] = counts
        self.ids[self.used : used] = ids
        self.size, self.used = size, used
        slot, todo = (keys >> np.uint64(20)).astype(np.int64) & (_SLOTS - 1), np.arange(len(keys))
        while len(todo):
            free = todo[self.rows[slot[todo]] < 0]
            _, winners = np.unique(slot[free], return_index=True)
            placed = free[winners]
            self.rows[slot[placed]], self.keys[slot[placed]] = rows[placed], keys[placed]
            todo = todo[~np.isin(todo, placed)]
            slot[todo] = (slot[todo] + (self.rows[slot[todo]] >= 0)) & (_SLOTS - 1)


class JsonEncoder:
    """The tokenizers library on a ``.json`` file.

    Where blanks only separate words, every word is cut into a run of plain letters and the marks behind it, or stays whole;
    a piece is encoded by the library once and its ids are found again by the hash of its bytes. The library's own store of words is
    too small for open vocabularies, and it normalises every word each time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        self.tool.no_truncation()
        self.tool.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        close = spec["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.tool.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tool.get_vocab(False).items() if close and t.endswith(close)]] = True
        self.by_piece = _splits_at_space(spec) and bool(self.ends.any())
        self.lowers = any(s["type"] == "Lowercase" for s in (spec.get("normalizer") or {}).get("normalizers", []))
        self.store = PieceStore()

    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tool.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, raw: bytes, text: bytes, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, plain: np.ndarray) -> None:
        """Encode new pieces: runs of letters many at once, as the last token of each, and no other, closes a word; one by one where that does
        not hold. ``text`` are the bytes that the store compares."""
        added = []
        for at in range(0, len(keys), 512):
            part = slice(at, at + 512)
            letters, others = np.flatnonzero(plain[part]) + at, np.flatnonzero(~plain[part]) + at
            if len(letters):
                ids = self._direct([b" ".join([raw[a:b] for a, b in zip(starts[letters].tolist(), ends[letters].tolist())]).decode()])[0]
                stops = np.flatnonzero(self.ends[ids]) + 1
                if len(stops) == len(letters) and stops[-1] == len(ids):
                    added.append((letters, np.diff(stops, prepend=0), ids))
                else:
                    others = np.arange(at, min(at + 512, len(keys)))
            if len(others):
                found = self._direct([raw[a:b].decode() for a, b in zip(starts[others].tolist(), ends[others].tolist())])
                added.append((others, np.array([len(x) for x in found]), np.concatenate(found)))
        for which, counts, ids in added:
            self.store.add(keys[which], [text[a:b] for a, b in zip(starts[which].tolist(), ends[which].tolist())], counts, ids)

    def _pieces(self, raw: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and kind (plain letters or not) of the pieces of one slice, in order."""
        starts, ends = words.bounds(raw, firsts)
        if not len(starts):
            return starts, ends, np.empty(0, bool)
        letters = _plain_letters(raw)
        other = np.flatnonzero(~letters)
        place = np.searchsorted(other, starts)
        stop = np.minimum(ends, np.append(other, len(raw))[place])
        marks = np.concatenate(([0], np.cumsum(_TAIL[raw])))
        plain = (stop > starts) & (marks[ends] - marks[stop] == ends - stop)
        two = plain & (stop < ends)
        slots = np.arange(len(starts)) + np.cumsum(two) - two
        total = len(starts) + int(two.sum())
        first, last, kind = np.empty(total, np.int64), np.empty(total, np.int64), np.zeros(total, bool)
        first[slots], last[slots], kind[slots] = starts, np.where(plain, stop, ends), plain
        first[slots[two] + 1], last[slots[two] + 1] = stop[two], ends[two]
        return first, last, kind

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids begin (one more entry at the end)."""
        if not self.by_piece:
            found = self._direct(column.fill_null("").to_pylist())
            return np.concatenate([np.empty(0, np.uint32), *found]), np.cumsum([0, *map(len, found)])
        raw, offsets = words.text_buffers(column)
        parts, begins, before, total = [np.empty(0, np.uint32)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
        for at, end, firsts in words.slices(raw, offsets):
            here = raw[at:end]
            starts, ends, plain = self._pieces(here, firsts)
            text = here
            if self.lowers:  # plain pieces count by their folded letters
                edges = np.zeros(len(here) + 1, np.int8)
                edges[starts[plain]] += 1
                edges[ends[plain]] -= 1
                text = np.where(np.cumsum(edges[:-1], dtype=np.int8) > 0, words.FOLD[here], here)
            keys = words.range_hashes(text, starts, ends, fold=False)
            if self.store.size > STORED_PIECES:
                self.store = PieceStore()
            rows, todo = np.empty(len(keys), np.int64), np.arange(len(keys))
            while len(todo):
                rows[todo] = self.store.find(keys[todo])
                fresh = todo[rows[todo] < 0]
                if len(fresh):
                    _, once = np.unique(keys[fresh], return_index=True)
                    once = fresh[np.sort(once)]
                    self._learn(here.tobytes(), text.tobytes(), keys[once], starts[once], ends[once], plain[once])
                    rows[fresh] = self.store.find(keys[fresh])
                # another piece has this hash: look under the next one
                todo = todo[~self.store.same(rows[todo], text, starts[todo], ends[todo])]
                keys[todo] = words.mix(keys[todo] + np.uint64(1))
            counts = self.store.count[rows]
            upto = np.cumsum(counts)
            if len(upto):
                parts.append(self.store.ids[np.repeat(self.store.first[rows] - upto + counts, counts) + np.arange(upto[-1])])
            begins.append(starts + at)
            before.append(total + upto - counts)
            total += int(upto[-1]) if len(upto) else 0
        begins, before = np.concatenate(begins), np.append(np.concatenate(before), total)
        return np.concatenate(parts), before[np.searchsorted(begins, offsets, "left")]


class PieceEncoder:
    """The sentencepiece library on a ``.model`` file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.tool = SentencePieceProcessor(model_file=path)

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(ids, np.uint32) for ids in self.tool.encode(column.fill_null("").to_pylist(), num_threads=1)]
        return np.concatenate([np.empty(0, np.uint32), *found]), np.cumsum([0, *map(len, found)])


@lru_cache(maxsize=2)
def encoder(path: str) -> JsonEncoder | PieceEncoder:
    """The encoder of a public tokenizer file; its ending tells the library."""
    return JsonEncoder(path) if path.endswith(".json") else PieceEncoder(path)
