import numpy as np
import pyarrow as pa
import pytest

from celltrace.llm import words
from tests.llm.helpers import shingle_set, twins, word_list

TEXTS = ["Hello world  a\tb\x0bC", "", None, "x", "  lead  ", "hello WORLD", "éÉ é e", "no\nyes", "w " * 5000]


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_word_hashes_tell_words_apart(monkeypatch, size):
    monkeypatch.setattr(words, "_SLICE", size)
    texts = [*TEXTS, "a" * 100 + " b " + "c" * 40, "d" * 16, "e" * 15 + " f", "g"]
    raw, offsets = words.text_buffers(pa.array(texts))
    hashes, firsts = words.word_hashes(raw, offsets)
    known = {}
    for text, a, b in zip(texts, firsts[:-1], firsts[1:]):
        expected = word_list(text)
        assert b - a == len(expected)
        for word, value in zip(expected, hashes[a:b].tolist()):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


def test_sliced_and_null_columns():
    column = pa.array(["drop", "a b", None, "c"]).slice(1)
    raw, offsets = words.text_buffers(column)
    assert raw.tobytes() == b"a bc" and offsets.tolist() == [0, 3, 3, 4]
    assert words.text_buffers(pa.array([], pa.string()))[1].tolist() == [0]


@pytest.mark.parametrize("width", [1, 2, 5])
def test_shingles_count_like_sets(width):
    for text in ["a b c d e f", "a a a a a a a", "a", "a b", "", "a b a b a b a b"]:
        raw, offsets = words.text_buffers(pa.array([text]))
        hashes, _ = words.word_hashes(raw, offsets)
        assert len(np.unique(words.shingles(hashes, width))) == len(shingle_set(text, width))


def test_words_of_two_letters_in_turn():
    """The Thue-Morse word and its complement have one value under any polynomial modulo a power of two."""
    for doubling in range(1, 13):
        a, b = twins(doubling)
        raw, offsets = words.text_buffers(pa.array([f"{a} {b}"]))
        hashes, _ = words.word_hashes(raw, offsets)
        assert len(set(hashes.tolist())) == 2


def test_short_words_never_share_a_hash():
    rng = np.random.default_rng(1)
    for size in (1, 3, 8):
        every = {"".join(map(chr, row)) for row in rng.integers(97, 123, (20_000, size))}
        raw, offsets = words.text_buffers(pa.array([" ".join(every)]))
        hashes, _ = words.word_hashes(raw, offsets)
        assert len(set(hashes.tolist())) == len(every)


def test_folding_is_a_choice():
    raw = np.frombuffer(b"Word" + b"Long" * 40, np.uint8)
    starts, ends = np.array([0, 4]), np.array([4, len(raw)])
    low = np.frombuffer(raw.tobytes().lower(), np.uint8)
    assert (words.range_hashes(raw, starts, ends) == words.range_hashes(low, starts, ends, fold=False)).all()
    assert (words.range_hashes(raw, starts, ends, fold=False) != words.range_hashes(low, starts, ends)).all()
