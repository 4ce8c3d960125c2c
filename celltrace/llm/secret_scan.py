"""Secrets in texts: fixed patterns, and a battery of randomness tests with false-discovery control.

Tokens outside the patterns are cut at ``-`` and ``_`` and get an inferred encoding (hex, base32, letters of one case or two, letters and digits
of one case or two, base64). Three tests ask how far the symbols are from a random key: a chi-squared test of the alphabet, a runs test around the
middle of the alphabet and the serial correlation of neighbours; the Bonferroni value of the three is the token's level of randomness.

What ordinary text looks like under the same tests is counted from the corpus itself: the short words of every document, run together and
written in each encoding's alphabet, in pieces of the least length of each length band. A token's value is the share of these pieces that
look at least as random; Benjamini and Hochberg's procedure over all tokens of the corpus, one per encoding and length band (the power of
the tests depends on the length), reports the tokens as ``random``, so that of those reported an expected share of ``FDR`` at most is text.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltrace.llm.scratch import Scratch
from celltrace.llm.words import small, text_buffers

# The base patterns, in the order of their kinds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Shortest token that is tested, and the shortest one of each length band.
LEAST = 12
BANDS = (12, 16, 32, 64)
FDR = 0.05
#: Symbols of ordinary text that make one piece of each band; pieces compared at once.
_STRETCH, _STEP = sum(BANDS), 1 << 12
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST)
_PART = re.compile(r"[A-Za-z0-9+/]{%d,}={0,2}" % LEAST)
_PLAIN = re.compile(r"[A-Za-z0-9]{%d,}" % LEAST)
#: Values are kept by their logarithm in steps of 1/100, down to this power of ten.
_STEPS, _LEAST = 100, 30
# The alphabets of the encodings; "fold" takes both cases as one.
_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "hex": _DIGITS + "abcdef", "base32": _UPPER + "234567", "letters": _LOWER, "letters2": _UPPER + _LOWER, "digits36": _DIGITS + _LOWER,
    "base62": _DIGITS + _UPPER + _LOWER, "base64": _UPPER + _LOWER + _DIGITS + "+/",
}
_FOLDED = {"hex", "letters", "digits36"}


def _table(name: str) -> np.ndarray:
    """Number of every byte in an alphabet, 255 for others."""
    out = np.full(256, 255, np.uint8)
    for i, c in enumerate(ALPHABETS[name]):
        out[ord(c)] = i
        if name in _FOLDED:
            out[ord(c.upper())] = i
    return out


_TABLES = {name: _table(name) for name in ALPHABETS}
_TOKEN_BYTE = np.zeros(256, bool)
_TOKEN_BYTE[[ord(c) for c in ALPHABETS["base64"] + "_-"]] = True


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns. Runs of the last two are maximal, so their least length can stand in the
    pattern; a short assignment is dropped after it has taken its place."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def infer(token: str) -> str | None:
    """Encoding of a token of letters, digits, + and /; None for mere numbers and for paths, which are cut further."""
    body = token.rstrip("=")
    digits, lower, upper = (any(p(c) for c in body) for p in (str.isdigit, str.islower, str.isupper))
    if "+" in body or "/" in body:
        return "base64" if digits and lower and upper else None
    if not (lower or upper):
        return None
    if lower and upper:
        return "base62" if digits else "letters2"
    if not digits:
        return "letters"
    if all(c in "0123456789abcdefABCDEF" for c in body):
        return "hex"
    return "base32" if upper and not set(body) & set("0189") else "digits36"


def erfc(x: np.ndarray) -> np.ndarray:
    """Complementary error function of numbers from 0 on, to seven digits (the Chebyshev fit of Numerical Recipes)."""
    t = 1.0 / (1.0 + 0.5 * x)
    sums = np.zeros_like(t)
    # The coefficients, highest power first.
    for c in (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        sums = sums * t + c
    return t * np.exp(sums - x * x)


def chi_squared_p(symbols: np.ndarray, size: int) -> np.ndarray:
    """Uniformity over as many equal groups of the alphabet as leave five symbols each (Wilson and Hilferty's tail), for every row."""
    n = symbols.shape[1]
    groups = max(2, min(size, n // 5))
    group = np.arange(size) * groups // size
    dealt, widths = group.astype(np.uint8)[symbols], np.bincount(group, minlength=groups)
    stat = np.zeros(len(symbols))
    for g in range(groups):
        mean = n * widths[g] / size
        stat += ((dealt == g).sum(axis=1) - mean) ** 2 / mean
    free = groups - 1
    z = ((stat / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free)) / math.sqrt(2)
    tail = 0.5 * erfc(np.abs(z))
    return np.where(z >= 0, tail, 1 - tail)


def runs_p(symbols: np.ndarray, size: int) -> np.ndarray:
    """Wald and Wolfowitz's runs of the lower and upper half of the alphabet."""
    high = 2 * symbols.astype(np.int16) >= size
    n, n1 = symbols.shape[1], high.sum(axis=1)
    n2 = n - n1
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 2 * n1 * n2 / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    p = np.where(spread > 0, erfc(np.abs(runs - mean) / np.sqrt(2 * np.where(spread > 0, spread, 1))), 1.0)
    return np.where((n1 == 0) | (n2 == 0), 2.0 ** (1 - n), p)


def serial_p(symbols: np.ndarray) -> np.ndarray:
    """Correlation of neighbours."""
    n = symbols.shape[1]
    gap = symbols - symbols.mean(axis=1, keepdims=True)
    total = (gap * gap).sum(axis=1)
    r = (gap[:, 1:] * gap[:, :-1]).sum(axis=1) / np.where(total > 0, total, 1)
    return np.where(total > 0, erfc(np.abs(r + 1 / n) * math.sqrt(n / 2)), 0.0)


def randomness_p(symbols: np.ndarray, size: int) -> np.ndarray:
    """Bonferroni value of the three tests for rows of symbol numbers: small where a random key is unlikely."""
    return np.minimum(1.0, 3 * np.minimum(np.minimum(chi_squared_p(symbols, size), runs_p(symbols, size)), serial_p(symbols)))


def levels(symbols: np.ndarray, size: int) -> np.ndarray:
    """``-100 log10`` of the values, rounded down: 0 looks random, large numbers do not."""
    out = np.empty(len(symbols), np.int32)
    for at in range(0, len(symbols), _STEP):
        p = np.maximum(randomness_p(symbols[at : at + _STEP], size), 10.0**-_LEAST)
        out[at : at + _STEP] = (-np.log10(p) * _STEPS).astype(np.int32)
    return out


def band(length: int) -> int:
    return max(b for b in BANDS if b <= length)


def tokens(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """``(start, end, encoding)`` of tokens apart from the base spans."""
    out, taken = [], []  # the base spans without overlaps, by start
    for start, end, _ in sorted(base):
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(end, taken[-1][1])
        else:
            taken.append([start, end])
    ends = [end for _, end in taken]

    def free(start: int, end: int) -> bool:
        near = bisect_right(ends, start)  # the first one that ends behind the start
        return near == len(taken) or taken[near][0] >= end

    for m in _TOKEN.finditer(text):
        for part in _PART.finditer(text, *m.span()):
            kind = infer(part[0])
            if kind:
                found = [(*part.span(), kind)]
            else:
                found = [(*p.span(), k) for p in _PLAIN.finditer(text, *part.span()) if (k := infer(p[0]))]
            out += [t for t in found if len(text[t[0] : t[1]].rstrip("=")) >= LEAST and free(t[0], t[1])]
    return out


def token_levels(texts: list[str], found: list[list[tuple[int, int, str]]]) -> list[list[tuple[int, int, str, int]]]:
    """The tokens of all texts with stratum and level; those of one encoding and length are tested side by side."""
    out, alike = [[None] * len(f) for f in found], {}
    for i, spans in enumerate(found):
        for j, (start, end, kind) in enumerate(spans):
            body = texts[i][start:end].rstrip("=")
            alike.setdefault((kind, len(body)), []).append((i, j, start, end, body))
    for (kind, length), members in alike.items():
        rows = _TABLES[kind][np.frombuffer("".join(m[4] for m in members).encode(), np.uint8)].reshape(-1, length)
        for (i, j, start, end, _), level in zip(members, levels(rows, len(ALPHABETS[kind])).tolist()):
            out[i][j] = (start, end, f"{kind}-{band(length)}", level)
    return out


def ordinary(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
    """``(stratum, levels)`` of the short words of every text, run together, in each alphabet and band.

    Every whole stretch of ``_STRETCH`` symbols of a text is one piece of each band; the rest of a text makes none.
    """
    inside = _TOKEN_BYTE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    edge = np.unique(np.concatenate([edge, offsets]))  # a text ends a word
    short = np.repeat(np.diff(np.append(edge, len(raw))) < LEAST, np.diff(np.append(edge, len(raw))))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for kind, table in _TABLES.items():
        symbols = table[raw]
        good = np.flatnonzero((symbols < 255) & short)
        counts = np.bincount(owner[good], minlength=len(offsets) - 1)
        place = np.arange(len(good)) - np.repeat(np.cumsum(counts) - counts, counts)
        whole = symbols[good[place < np.repeat(counts // _STRETCH * _STRETCH, counts)]].reshape(-1, _STRETCH)
        if len(whole):
            for least, first in zip(BANDS, np.cumsum((0, *BANDS))):
                yield f"{kind}-{least}", levels(whole[:, first : first + least], len(ALPHABETS[kind]))


def reported_levels(tested: DataFrame, ordinary_: DataFrame, fdr: float) -> DataFrame:
    """``(stratum, cut)``: tokens of a stratum with a level of at most ``cut`` are reported by Benjamini and Hochberg's rule.

    ``tested(stratum, level, n)`` and ``ordinary_(stratum, level, n)`` are counts, bounded whatever the corpus. A token's value is
    ``(1 + pieces of ordinary text with its level or less) / (1 + all pieces)``.
    """
    both = tested.select("stratum", "level", "n", F.lit(0).cast("long").alias("text")).unionByName(ordinary_.select("stratum", "level", F.lit(0).cast("long").alias("n"), F.col("n").alias("text")))
    counts = both.groupBy("stratum", "level").agg(F.sum("n").alias("n"), F.sum("text").alias("text"))
    whole = Window.partitionBy("stratum")
    upto = whole.orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.select("stratum", "level", "n", F.sum("n").over(upto).alias("rank"), F.sum("n").over(whole).alias("m"), F.sum("text").over(upto).alias("t"), F.sum("text").over(whole).alias("all"))
    value = (1 + F.col("t")) / (1 + F.col("all"))
    return ranked.filter((F.col("n") > 0) & (value * F.col("m") <= F.lit(fdr) * F.col("rank"))).groupBy("stratum").agg(F.max("level").alias("cut"))


def scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text", fdr: float = FDR) -> DataFrame:
    """``(id, n_assign, n_access, n_hex, base_sha256, spans)`` per row of ``docs``; spans count code points, end exclusive.

    Null texts count as empty; repeated rows are scanned each; ties of a start go by the order of the kinds. A corpus without ordinary
    text has nothing to tell keys from, and reports none as ``random``.
    """
    names = ["id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "tokens", "ordinary"]
    fields = T.StructType.fromDDL(
        "n_assign long, n_access long, n_hex long, base_sha256 string, base array<struct<start:long,kind:int,end:long>>, "
        "tokens array<struct<start:long,end:long,stratum:string,level:int>>, ordinary array<struct<stratum:string,level:int,n:long>>"
    )
    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType), *fields.fields])
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    token_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("stratum", pa.string()), ("level", pa.int32())]))
    count_type = pa.list_(pa.struct([("stratum", pa.string()), ("level", pa.int32()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        id_type = None
        for batch in small(batches):
            id_type = batch.column(0).type
            counts, sums, bases, texts = [[], [], []], [], [], [value.as_py() or "" for value in batch.column(1)]
            spans = [base_spans(body) for body in texts]
            found = token_levels(texts, [tokens(body, base) for body, base in zip(texts, spans)])
            for base in spans:
                base = sorted((start, KINDS.index(kind), end) for start, end, kind in base)
                for k in range(3):
                    counts[k].append(sum(kind == k for _, kind, _ in base))
                sums.append(hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest())
                bases.append([dict(zip(("start", "kind", "end"), b)) for b in base])
            found = [[dict(zip(("start", "end", "stratum", "level"), t)) for t in f] for f in found]
            for stratum, level in ordinary(*text_buffers(batch.column(1))):
                seen.setdefault(stratum, np.zeros(_STEPS * _LEAST + 1, np.int64))
                seen[stratum] += np.bincount(level, minlength=_STEPS * _LEAST + 1)
            columns = [*(pa.array(c, pa.int64()) for c in counts), pa.array(sums), pa.array(bases, span_type), pa.array(found, token_type)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.nulls(batch.num_rows, count_type)], names)
        if seen:  # the counts of the whole task as a row of their own
            counted = [{"stratum": s, "level": int(i), "n": int(n[i])} for s, n in seen.items() for i in np.flatnonzero(n)]
            blank = [pa.nulls(1, id_type), *(pa.nulls(1, pa.int64()) for _ in range(3)), pa.nulls(1, pa.string()), pa.nulls(1, span_type), pa.nulls(1, token_type)]
            yield pa.RecordBatch.from_arrays([*blank, pa.array([counted], count_type)], names)

    scanned = Scratch(docs.sparkSession).cut(docs.select(F.col(id_column), F.col(text).cast("string")).mapInArrow(run, schema), "scanned")
    tested = scanned.select(F.explode("tokens").alias("t")).groupBy("t.stratum", "t.level").agg(F.count(F.lit(1)).alias("n"))
    pieces = scanned.select(F.explode("ordinary").alias("t")).groupBy("t.stratum", "t.level").agg(F.sum("t.n").alias("n"))
    # at most one entry per encoding and length band
    cuts = reported_levels(tested, pieces, fdr).agg(F.map_from_entries(F.collect_list(F.struct("stratum", "cut"))).alias("cuts"))
    out = scanned.filter("ordinary is null").withColumn("cuts", cuts.scalar())
    kept = F.filter("tokens", lambda t: F.coalesce(t["level"] <= F.try_element_at(F.col("cuts"), t["stratum"]), F.lit(False)))
    more = F.transform(kept, lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind"), t["end"].alias("end")))
    kinds = F.array(*map(F.lit, KINDS))
    spans = F.array_sort(F.concat("base", more))
    written = F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return out.select(F.col("id").alias(id_column), "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(written, ",").alias("spans"))
