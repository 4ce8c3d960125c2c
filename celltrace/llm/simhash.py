"""Near duplicates by SimHash with deletion-variant signatures.

Two fingerprints of 64 bits that differ in three bits at most, cut into two segments of 32 bits, differ in one segment by one bit at most. Every
fingerprint is indexed under the variants of its segments in which one bit is left out (a wildcard); two segments that differ by
at most one bit have a variant in common. Fingerprints that meet by an equal variant are verified on all 64 bits.

1. Rows of equal fingerprints form one class; only classes are indexed, 64 variants each.
2. The classes of a variant arrive sorted, a bounded number at a time. A variant of few classes yields its verified pairs, one of more classes a
   spanning forest of its links, never all pairs.
3. A variant of more classes than ``HELD`` is split once more by the same rule: inside it the other segment differs in three bits
   at most, so one of its halves of 16 bits differs by one bit at most, and its 32 one-wildcard variants split the classes.
   What is still above the bound is so dense that its classes are nearly all linked; it is compared in pairs of parts.

Components of the links are named by their smallest id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltrace.llm.components import components
from celltrace.llm.scratch import Scratch
from celltrace.llm.words import small

#: Bits by which linked fingerprints differ at most: what two segments with one wildcard can find.
DISTANCE = 3
#: Classes of one variant that a task compares with each other.
HELD = 8192
#: Classes of one variant up to which all its verified pairs are links; above, a spanning forest is.
FEW = 32
_SLICE = 1 << 18
_BREAK = re.compile(rb"[\x20\x09-\x0D]")


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of ``text``, repeats included: a bit is set if it is in over half of the hashes.

    A text of fewer words is one shingle, one without words has fingerprint zero. Long texts go slice by slice, cut at white space.
    """
    ones, n, tail, at = np.zeros(64, np.int64), 0, [], 0
    while at < len(text):
        stop = _BREAK.search(text, at + _SLICE)
        end = stop.start() if stop else len(text)
        found = tail + text[at:end].lower().split()  # folds A-Z and splits at the same white space as the words are cut
        digests = [xxhash.xxh64_digest(b" ".join(s), seed) for s in zip(*(found[k:] for k in range(width)))]
        if digests:
            n += len(digests)
            bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(axis=0, dtype=np.int64)
        tail, at = (found[1 - width :] if width > 1 else []), end
    if not n and tail:
        return xxhash.xxh64_intdigest(b" ".join(tail), seed)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_column: str, text: str, width: int, seed: int) -> DataFrame:
    """``(id, fp)`` per row; a null text counts as empty."""
    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            values = np.array([fingerprint(v.as_py() or b"", width, seed) for v in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], schema.names)

    return docs.select(F.col(id_column), F.col(text).cast("string").cast("binary")).mapInArrow(run, schema)


def wildcards(segment: Column, bits: int, no: int) -> Column:
    """All variants of a segment with one bit left out; the number of the segment and the place of the bit stand above its value."""
    places = F.sequence(F.lit(0).cast("long"), F.lit(bits - 1).cast("long"))
    full = (1 << bits) - 1

    def variant(j: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), j.cast("int"))
        return (F.lit(no * bits) + j) * F.lit(full + 1) + segment.bitwiseAND(F.lit(full) - bit)

    return F.transform(places, variant)


def segments(value: Column, bits: int) -> tuple[Column, Column]:
    """Upper and lower half of a number of ``2 * bits`` bits."""
    mask = F.lit((1 << bits) - 1)
    return F.shiftrightunsigned(value, bits).bitwiseAND(mask), value.bitwiseAND(mask)


def first_shared(key: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ``key`` is the first of all variants that ``a`` and ``b`` share, so that a pair counts once."""
    no, place = key >> 37, (key >> 32) & 31
    upper, lower = ((a ^ b) >> np.uint64(32)), (a ^ b) & np.uint64(0xFFFFFFFF)
    upper_bits = np.bitwise_count(upper)
    own = np.where(no == 0, upper, lower)
    return ((no == 0) | (upper_bits > 1)) & ((own != 0) | (place == 0))


def forest(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect exactly what all links among ``values`` connect, one fewer than the members of each component."""
    left, right, waiting = [], [], values.copy()
    while len(waiting):
        todo, waiting = [waiting[-1]], waiting[:-1]
        while todo and len(waiting):
            one = todo.pop()
            near = np.bitwise_count(waiting ^ one) <= distance
            if near.any():
                met = waiting[near]
                left.append(np.full(len(met), one))
                right.append(met)
                todo.extend(met)
                waiting = waiting[~near]
    none = np.empty(0, np.uint64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def meetings(rows: DataFrame, place: list[str], held: int | None, distance: int) -> DataFrame:
    """``(key, sub, a, b)``: links among the classes of every place; classes of a place with more than ``held`` come
    back with a null ``b``.

    ``rows(key, sub, ..., fp)`` hold a fingerprint once per place; ``key`` is its variant, ``place`` the columns that tell places apart.
    """

    def answer(key, sub, a, b=None):
        a = pa.array(np.ascontiguousarray(a).view(np.int64))
        b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(np.ascontiguousarray(b).view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(key, len(a)), pa.int64()), pa.array(np.broadcast_to(sub, len(a)), pa.int64()), a, b], ["key", "sub", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept, count, over = None, [], 0, False

        def close():
            if over:
                if kept:
                    yield answer(now[0], now[1], np.concatenate(kept))
            elif count > 1:
                left, right = forest(np.concatenate(kept), distance)
                yield answer(now[0], now[1], left, right)

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            names, fp = columns[:-1], columns[-1].view(np.uint64)
            new = np.zeros(len(fp), bool)
            new[0] = True
            for c in names:
                new[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], len(fp))
            first = tuple(int(c[0]) for c in names)
            inner = slice(0, len(starts) - 1)  # places that end in this batch and began in it
            if first == now:  # the place of the batch before goes on
                kept.append(fp[: ends[0]])
                count += int(ends[0])
                if held is not None and count > held:
                    over = True
                    yield answer(now[0], now[1], np.concatenate(kept))
                    kept = []
                if len(starts) == 1:
                    continue
                inner = slice(1, len(starts) - 1)
            yield from close()
            # whole places: the small ones at once, neighbours, then neighbours but one, ...
            sizes = ends[inner] - starts[inner]
            ids = np.repeat(np.arange(len(sizes)), sizes)
            if len(ids):
                low = starts[inner][0]
                body, key = fp[low : low + len(ids)], names[0][low : low + len(ids)]
                few = np.flatnonzero((sizes <= FEW)[ids] & (sizes > 1)[ids])
                for d in range(1, FEW):
                    few = few[few + d < len(ids)]
                    few = few[ids[few] == ids[few + d]]
                    if not len(few):
                        break
                    a, b = body[few], body[few + d]
                    good = np.bitwise_count(a ^ b) <= distance
                    good[good] = first_shared(key[few[good]], a[good], b[good])
                    if good.any():
                        yield answer(key[few[good]], 0, a[good], b[good])
                for i in np.flatnonzero(sizes > FEW):
                    at = starts[inner][i]
                    if held is not None and sizes[i] > held:
                        yield answer(int(names[0][at]), int(names[1][at]), fp[at : at + sizes[i]])
                        continue
                    left, right = forest(fp[at : at + sizes[i]], distance)
                    yield answer(int(names[0][at]), int(names[1][at]), left, right)
            at = starts[-1]
            now, kept, count = tuple(int(c[at]) for c in names), [fp[at:]], len(fp) - int(at)
            over = held is not None and count > held
        yield from close()

    whole = rows.select(*place, "fp").repartition(*place).sortWithinPartitions(*place)
    return whole.mapInArrow(run, "key long, sub long, a long, b long")


def links(scratch: Scratch, classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(a, b)`` of distinct fingerprints ``classes(fp)``: links that connect whatever differs by ``distance`` bits at most."""
    upper, lower = segments(F.col("fp"), 32)
    indexed = classes.select(F.explode(F.concat(wildcards(upper, 32, 0), wildcards(lower, 32, 1))).alias("key"), F.lit(0).cast("long").alias("sub"), "fp")
    found = scratch.cut(meetings(indexed, ["key", "sub"], HELD, distance), "met-1")
    out, crowded = found.filter("b is not null").select("a", "b"), found.filter("b is null")
    if not crowded.isEmpty():  # inside a variant the other segment decides
        upper, lower = segments(F.col("fp"), 32)
        other = F.when(F.shiftright("key", 37) == 0, lower).otherwise(upper)
        high, low = segments(other, 16)
        split = crowded.select("key", F.col("a").alias("fp")).select("key", F.explode(F.concat(wildcards(high, 16, 0), wildcards(low, 16, 1))).alias("sub"), "fp")
        found = scratch.cut(meetings(split, ["key", "sub"], HELD, distance), "met-2")
        out, dense = out.union(found.filter("b is not null").select("a", "b")), found.filter("b is null").select("key", "sub", F.col("a").alias("fp"))
        if not dense.isEmpty():
            sizes = dense.groupBy("key", "sub").agg(F.ceil(F.count(F.lit(1)) * 2 / HELD).cast("int").alias("parts"))
            dealt = dense.join(sizes, ["key", "sub"]).withColumn("own", F.pmod(F.xxhash64("fp"), "parts").cast("int"))
            dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            dealt = dealt.select("key", "sub", F.least("own", "with").cast("long").alias("low"), F.greatest("own", "with").cast("long").alias("high"), "fp")
            found = scratch.cut(meetings(dealt, ["key", "sub", "low", "high"], None, distance), "met-3")
            out = out.union(found.select("a", "b"))
    return out


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 3, seed: int = 42, distance: int = DISTANCE, scratch: Scratch | None = None) -> DataFrame:
    """``(id, fingerprint, component_id)`` per row of ``docs``; rows link if their fingerprints differ in ``distance`` bits at most.

    Null texts and texts without words have fingerprint zero, which links like any other; equal texts, and rows of the same id and text, share a
    component. A null id names a component only if all its ids are null. Other columns of ``docs`` are not read.
    """
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"two segments with one wildcard find differences of up to {DISTANCE} bits")
    scratch = scratch or Scratch(docs.sparkSession)
    signed = scratch.cut(fingerprints(docs, id_column, text, width, seed), "signed")
    classes = scratch.cut(signed.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    named = scratch.cut(components(scratch, links(scratch, classes, distance), "linked"), "named")
    whole = classes.join(named.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    final = scratch.cut(whole.select("fp", "component").join(names, "component").select("fp", "component_id"), "final")
    scratch.drop("met-1", "met-2", "met-3", "classes", "named")
    out = signed.join(final, "fp")
    return out.select(F.col("id").alias(id_column), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
