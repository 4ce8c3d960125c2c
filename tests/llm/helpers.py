"""Small texts and brute-force versions that the operator tests share."""

from __future__ import annotations

import random
import re

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; tables of a user may have them too.
CLASHES = ["id", "cid", "bands", "row", "part", "offset", "size", "hash", "component", "posterior", "evidence", "_evidence", "place", "block", "digest", "host", "c0", "_row", "kept"]


def fold(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def word_list(text: str | None) -> list[str]:
    return SPLIT.findall(fold(text or ""))


def shingle_set(text: str | None, width: int) -> frozenset:
    w = word_list(text)
    if not w:
        return frozenset()
    width = min(width, len(w))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def components(sets: dict, percent: int = 80) -> dict:
    """Smallest linked id per id, by comparing all pairs."""
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    names = sorted(sets)
    for n, a in enumerate(names):
        for b in names[:n]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {i: root(i) for i in sets}


def random_text(rnd: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(words))


def edited(rnd: random.Random, text: str, edits: int) -> str:
    w = text.split()
    for _ in range(edits):
        w[rnd.randrange(len(w))] = f"e{rnd.randrange(10_000)}"
    return " ".join(w)


def with_clashes(df, skip=()):
    """``df`` with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    taken = {c.lower() for c in df.columns} | set(skip)
    return df.select("*", *(F.lit(f"extra {c}").alias(c) for c in CLASHES if c not in taken))


def nothing(spark, schema: str):
    return spark.createDataFrame([], schema)


def twins(doubling: int) -> tuple[str, str]:
    """The Thue-Morse word over a and b of ``2 ** doubling`` letters, and its complement."""
    word = "a"
    for _ in range(doubling):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))
