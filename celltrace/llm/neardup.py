"""Near duplicates by circulant MinHash, banding and exact Jaccard checks.

Circulant MinHash (Li and Li, 2021) draws all signature coordinates from two permutations: the first one spreads the
shingles over the domain of 64-bit numbers, the second one is shifted by one more step for every coordinate.

The search keeps every link between different shingle sets that share a band, without making all pairs of a group:

1. Documents with equal sets form one class; only classes go on.
2. Every band bucket is compared with its most central class, the one that shares most buckets with others. Large groups
   of near copies fall into one component here.
3. Classes of a bucket that are still in different components are compared by their whole signatures; where these agree
   well enough for the threshold, the class of the smaller component is compared with the blocks of the larger one. A bucket of many classes is
   split by the rarest shingles of each class first, as many of them as it takes for any two sets at the threshold to share one (prefix
   filter): no link of the bucket is lost, and classes that have nothing but this bucket in common never meet.

Comparisons run in sorted streams: a block holds a bounded part in memory, and the others pass by. Links are
confirmed on full shingle sets. With 32 bands of 4 rows a pair at the threshold of 0.8 shares no band with
probability 5e-8; step 3 misses one that does with probability 1e-7 at most.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltrace.llm import words
from celltrace.llm.components import components
from celltrace.llm.scratch import Scratch, numbered

#: Shingles of one comparison block, and members of a bucket that one block compares with its central class.
BLOCK_SHINGLES = 1 << 19
BLOCK_MEMBERS = 512
#: Classes of one signature block, and others that pass by it.
SKETCH_ANCHORS, SKETCH_STREAM = 1024, 1 << 16
#: Classes of a bucket above which it is split by the rarest shingles of its classes.
LARGE_BUCKET = 2048
#: Chance that a pair at the threshold agrees in fewer coordinates than step 3 asks for.
MISS = 1e-7
_CELLS = 1 << 16


def circulant_signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` MinHash coordinates of a non-empty set of 64-bit shingles."""
    spread = words.mix(shingles ^ np.uint64(0x5851F42D4C957F2D))  # first permutation
    shifts = np.arange(1, size + 1, dtype=np.uint64)
    best = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    step = max(1, _CELLS // size)
    for at in range(0, len(spread), step):
        z = spread[at : at + step, None] + shifts  # circular shift of the domain
        z ^= z >> np.uint64(33)  # second permutation
        z *= np.uint64(0xFF51AFD7ED558CCD)
        z ^= z >> np.uint64(29)
        z *= np.uint64(0xC4CEB9FE1A85EC53)
        np.minimum(best, z.min(axis=0), out=best)
    return best


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band; equal keys of different bands do not meet."""
    rows = signature.reshape(bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows.shape[1]):
        key = words.mix(key * np.uint64(0x9FB21C651E98DF25) + rows[:, k])
    return key.view(np.int64)


def signatures(docs: DataFrame, id_column: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """``(id, text_hash, n_shingles, set_key, bands, sketch)`` per row; a text without words has no key, bands and sketch.
    The sketch holds the low byte of every coordinate."""
    kind = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField("id", kind), T.StructField("text_hash", T.LongType()), T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                raw, offsets = words.text_buffers(part.column(1))
                hashes, firsts = words.word_hashes(raw, offsets)
                counts, keys, found, sketches, ends = [], [], [], [], [0]
                for first, last in zip(firsts[:-1], firsts[1:]):
                    items = np.unique(words.shingles(hashes[first:last], width))
                    counts.append(len(items))
                    keys.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
                    signature = circulant_signature(items, bands * rows) if len(items) else None
                    sketches.append(None if signature is None else signature.astype(np.uint8).tobytes())
                    if len(items):
                        found.append(band_keys(signature, bands))
                    ends.append(ends[-1] + bands * bool(len(items)))
                flat = np.concatenate(found) if found else np.empty(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
                columns = [part.column(0), part.column(2), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), lists, pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    body = F.col(text).cast("string")
    return docs.select(F.col(id_column), body, F.xxhash64(body)).mapInArrow(run, schema)


def shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """``(cid, set_key, items)`` of ``texts(cid, set_key, text)``, only where the text still has the key's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raw, offsets = words.text_buffers(part.column(2))
                hashes, firsts = words.word_hashes(raw, offsets)
                sets = [np.unique(words.shingles(hashes[a:b], width)).tobytes() for a, b in zip(firsts[:-1], firsts[1:])]
                same = [hashlib.blake2b(s, digest_size=16).digest() == k for s, k in zip(sets, part.column(1).to_pylist())]
                out = pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["cid", "items"])
                yield out.filter(pa.array(same, pa.bool_()))

    return texts.select("cid", "set_key", "text").mapInArrow(run, "cid long, items binary")


def compare(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between the anchors (role 0) and the other members (role 1) of every block.

    ``blocks(block, part, role, cid)``: a block's rows come sorted by role, so its anchors are held
    and the others pass by; the anchors of one part are bounded by the caller.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, names, held, index = None, [], [], None
        for batch in batches:
            left, right = [], []
            columns = [batch.column(i).to_pylist() for i in range(4)]
            items_column = batch.column(4)
            for i, (block, part, role, cid) in enumerate(zip(*columns)):
                items = np.frombuffer(items_column[i].as_buffer(), np.uint64)
                if (block, part) != current:
                    current, names, held, index = (block, part), [], [], None
                if role == 0:
                    names.append(cid)
                    held.append(items)
                    continue
                if not names:
                    continue
                if index is None:
                    sizes = np.array([len(x) for x in held])
                    values = np.concatenate(held)
                    order = np.argsort(values, kind="stable")
                    index = values[order], np.repeat(np.arange(len(held)), sizes)[order], sizes, np.array(names)
                    held = []
                values, owners, sizes, ids = index
                low, high = np.searchsorted(values, items, "left"), np.searchsorted(values, items, "right")
                runs = high - low
                places = np.repeat(low - np.concatenate(([0], np.cumsum(runs)[:-1])), runs) + np.arange(runs.sum())
                shared = np.bincount(owners[places], minlength=len(sizes))
                linked = ids[100 * shared >= percent * (sizes + len(items) - shared)]
                left += [cid] * len(linked)
                right += linked.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    rows = blocks.join(sets, "cid").select("block", "part", "role", "cid", "items")
    return rows.repartition("block", "part").sortWithinPartitions("block", "part", "role").mapInArrow(run, "a long, b long")


def least_agreement(size: int, percent: int) -> int:
    """Equal coordinates of ``size`` below which a pair at the threshold falls with probability ``MISS`` at most."""
    p, below = percent / 100, 0.0
    for k in range(size + 1):
        below += math.comb(size, k) * p**k * (1 - p) ** (size - k)
        if below > MISS:
            return k
    return size


def candidates(rows: DataFrame, agreement: int) -> DataFrame:
    """``(cid, block)``: classes of smaller components that may be linked with the larger component ``block``.

    ``rows(bucket, part, sub, role, cid, component, weight, bands, sketch)``: the anchors (role 0) of a block are held, the
    others pass by. A pair counts in the first band that it shares.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, index, seen = None, [], None, set()
        for batch in batches:
            out = []
            flat = np.asarray(batch.column(7).flatten())
            bands = flat.reshape(batch.num_rows, -1) if batch.num_rows else flat.reshape(0, 1)
            sketches = batch.column(8)
            for i, (bucket, part, sub, role, cid, component, weight) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(7)))):
                if (bucket, part, sub) != current:
                    current, held, index, seen = (bucket, part, sub), [], None, set()
                sketch = np.frombuffer(sketches[i].as_buffer(), np.uint8)
                if role == 0:
                    held.append((cid, component, weight, bands[i], sketch))
                    continue
                if not held:
                    continue
                if index is None:
                    cids, components_, weights = (np.array([h[k] for h in held]) for k in range(3))
                    index = cids, components_, weights, np.stack([h[3] for h in held]), np.stack([h[4] for h in held])
                cids, components_, weights, held_bands, held_sketches = index
                smaller = np.flatnonzero((weights < weight) | ((weights == weight) & (components_ < component)))
                if not len(smaller):
                    continue
                smaller = smaller[(held_sketches[smaller] == sketch).sum(axis=1) >= agreement]
                before = int(np.argmax(bands[i] == bucket))
                smaller = smaller[~(held_bands[smaller, :before] == bands[i, :before]).any(axis=1)]
                for x in cids[smaller].tolist():
                    if (x, component) not in seen:
                        seen.add((x, component))
                        out.append((x, component))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["cid", "block"])

    keys = ["bucket", "part", "sub"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "role").mapInArrow(run, "cid long, block long").distinct()


def mixed(grouped: DataFrame) -> DataFrame:
    """``(bucket, cid, component)`` of the buckets that hold more than one component."""
    several = grouped.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("bucket")
    return grouped.join(several, "bucket").select("bucket", "cid", "component")


def rare_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """``(cid, shingle)``: of every set in ``sets(cid, items)`` the rarest shingles, so many that two sets at the threshold have one in common.

    A link needs ``percent`` of the larger set in common. So of the shingles of both sets, in one order for all, the first of them are shared unless
    more than the rest of a set comes before. Shingles of one set alone take a place but meet nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, items in zip(batch.column(0), batch.column(1)):
                found = np.frombuffer(items.as_buffer(), np.int64)
                columns = [np.full(len(found), cid.as_py()), found, np.full(len(found), len(found))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cid", "shingle", "n"])

    listed = sets.select("cid", "items").mapInArrow(run, "cid long, shingle long, n long")
    held = listed.groupBy("shingle").agg(F.count(F.lit(1)).alias("held"))
    place = F.row_number().over(Window.partitionBy("cid").orderBy("held", "shingle"))
    spare = F.col("n") - F.floor((F.col("n") * percent + 99) / 100)
    return listed.join(held, "shingle").withColumn("place", place).filter((F.col("place") <= spare + 1) & (F.col("held") > 1)).select("cid", "shingle")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = 32,
    rows: int = 4,
    scratch: Scratch | None = None,
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Linked are rows whose sets of ``width``-word shingles have ``100 * shared >= percent * all``; a component is named by
    its smallest id and that row is kept. Texts that are null or have no word are linked with nothing and stay; rows of
    the same id and equal sets share a component; a null id never names a component with other ids. Other columns
    of ``docs`` are not read.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    signed = scratch.cut(signatures(docs, id_column, text, width, bands, rows), "signed")
    classes = (
        signed.filter("n_shingles > 0").groupBy("set_key")
        .agg(F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("first"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .select("set_key", F.col("first.id").alias("first_id"), F.col("first.text_hash").alias("text_hash"), "n", "bands", "sketch")
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = scratch.cut(classes, "classes")  # from here on the numbers stand

    # Buckets of two and more classes, every class with the number of others that it meets in all its buckets.
    banded = classes.select("cid", "n", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = scratch.cut(banded.join(sizes, "bucket"), "members")
    meets = members.groupBy("cid").agg(F.sum("size").alias("meets"))
    central = members.join(meets, "cid").groupBy("bucket").agg(F.max(F.struct("meets", "cid"))["cid"].alias("block"))

    needed = scratch.cut(members.select("cid").distinct().join(classes, "cid").select("cid", "set_key", "first_id", "text_hash"), "needed")
    body = F.col(text).cast("string")
    found = docs.select(F.col(id_column).alias("first_id"), F.xxhash64(body).alias("text_hash"), body.alias("text"))
    same = found["first_id"].eqNullSafe(needed["first_id"]) & (found["text_hash"] == needed["text_hash"])  # an id may stand for many texts
    both = found.join(needed, same).select("cid", "set_key", "text")
    sets = scratch.cut(shingle_sets(both, width).dropDuplicates(["cid"]), "sets")

    # Every bucket with its central class.
    pairs = members.join(central, "bucket").filter("cid != block").select("block", "cid").distinct()
    counts = pairs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS).alias("parts"))
    pairs = pairs.join(counts, "block").select("block", F.pmod(F.xxhash64("cid"), "parts").cast("int").alias("part"), "cid")
    anchors = counts.select("block", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("part"), F.col("block").alias("cid"))
    blocks = anchors.withColumn("role", F.lit(0)).unionByName(pairs.withColumn("role", F.lit(1)))
    links = scratch.cut(compare(blocks, sets, percent), "links-1")
    first = scratch.cut(components(scratch, links, "first"), "first-components")

    # Buckets that still hold more than one component: the smaller ones against blocks of the larger ones.
    grouped = members.join(first.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    grouped = mixed(grouped)
    large = scratch.cut(grouped.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LARGE_BUCKET).select("bucket"), "large")
    crowd = scratch.cut(grouped.join(large, "bucket").select("cid", "component").distinct(), "crowd")
    split = rare_shingles(sets.join(crowd, "cid", "left_semi"), percent).join(crowd, "cid").select(F.col("shingle").alias("bucket"), "cid", "component")
    grouped = scratch.cut(grouped.join(large, "bucket", "left_anti").select("bucket", "cid", "component").unionByName(mixed(split)), "grouped")
    everyone = classes.select("cid", "n").join(first.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    weights = everyone.groupBy("component").agg(F.sum("n").alias("weight")).join(grouped.select("component").distinct(), "component")
    weights = scratch.cut(weights.withColumn("parts", F.ceil(F.col("weight") / BLOCK_SHINGLES).cast("int")), "weights")
    grouped = grouped.join(weights.drop("parts"), "component")
    inside = grouped.groupBy("bucket", "component").agg(F.first("weight").alias("weight"), F.count(F.lit(1)).alias("n"))
    tops = inside.groupBy("bucket").agg(F.max(F.struct("weight", "component", "n")).alias("top"), F.sum("n").alias("n"))
    tops = tops.select(
        "bucket", F.col("top.component").alias("top"),
        F.ceil((F.col("n") - F.col("top.n")) / SKETCH_ANCHORS).cast("int").alias("parts"), F.ceil(F.col("n") / SKETCH_STREAM).cast("int").alias("subs"),
    )
    rows_ = grouped.join(tops, "bucket").join(classes.select("cid", "bands", "sketch"), "cid")
    chosen = ["bucket", "part", "sub", "role", "cid", "component", "weight", "bands", "sketch"]
    place = F.xxhash64("cid")
    held = rows_.filter("component != top").withColumn("role", F.lit(0)).withColumn("part", F.pmod(place, "parts").cast("int"))
    held = held.withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))).select(*chosen)
    passing = rows_.withColumn("role", F.lit(1)).withColumn("sub", F.pmod(place, "subs").cast("int"))
    passing = passing.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(*chosen)
    pairs = candidates(held.unionByName(passing), least_agreement(bands * rows, percent))
    pairs = scratch.cut(pairs.join(weights.select(F.col("component").alias("block"), "parts"), "block"), "pairs")
    others = pairs.select("block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "cid", F.lit(1).alias("role"))
    held = everyone.join(pairs.select(F.col("block").alias("component"), "parts").distinct(), "component")
    held = held.select(F.col("component").alias("block"), F.pmod(F.xxhash64("cid"), "parts").cast("int").alias("part"), "cid", F.lit(0).alias("role"))
    more = scratch.cut(compare(held.unionByName(others), sets, percent), "links-2")
    named = first.select(F.col("node"), F.col("component").alias("to"))
    for side in ("a", "b"):
        more = more.join(named.withColumnRenamed("node", side), side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
    second = components(scratch, more, "second")

    # From classes to documents.
    final = everyone.join(second.select(F.col("node").alias("component"), F.col("component").alias("last")), "component", "left")
    final = final.select("cid", F.coalesce("last", "component").alias("component")).join(classes.select("cid", "set_key", "first_id"), "cid")
    names = final.groupBy("component").agg(F.min("first_id").alias("component_id"))
    final = scratch.cut(final.join(names, "component").select("set_key", "component_id"), "final")
    scratch.drop("large", "crowd", "members", "needed", "sets", "pairs", "links-1", "links-2", "first-components", "grouped", "weights", "classes")
    out = signed.select("id", "n_shingles", "set_key").join(final, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_column), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def keep_first(docs: DataFrame, id_column: str = "doc_id", text: str = "text", scratch: Scratch | None = None, **search) -> DataFrame:
    """``docs`` with one row per group of near duplicates, the one with the smallest id (nulls last); all its columns stay.

    Only texts link rows: rows that share an id, also a null one, are rows of their own. Ties go by text hash.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    plain, name = numbered(docs)
    own, body = F.col(name[id_column]), F.col(name[text])
    rows = scratch.cut(plain.withColumn("row", F.monotonically_increasing_id()), "rows")  # from here on the numbers stand
    key = F.struct(own.isNull().alias("missing"), own.alias("id"), F.xxhash64(body.cast("string")).alias("hash"), F.col("row"))
    found = near_duplicates(rows.select(key.alias("key"), body.alias("text")), "key", "text", scratch=scratch, **search)
    kept = found.filter("kept").select(F.col("key.row").alias("row"))
    return rows.join(kept, "row").select(*plain.columns).toDF(*docs.columns)
