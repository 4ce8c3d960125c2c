"""Mixing sources to target weights by blocks of fixed length.

The words of a source, in the order of its documents, form one stream that is cut into blocks of ``block_words`` words.
Every output shard draws how many blocks it takes from each source (multinomial, by the targets); the draws of a source are
numbered over all shards and go through a pseudorandom permutation of its block numbers, one permutation per pass
over the source, so no block comes a second time before all have come once. Slots and blocks meet by block number. What a
source has drawn above its quota of blocks is cancelled, and the last shard takes what is missing, so the total is right for small
sources too. All randomness comes from the seed and stable numbers: a rerun gives the same mix.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltrace.llm.scratch import Scratch, numbered
from celltrace.llm.words import small

#: A mixture is one weight per source; its rows are sent to every draw.
MAX_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"
SLOTS_PER_TASK = 1 << 17
WEIGHTS = (3.0, 1.0, 2.0)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sizes: list[int], weights: list[float], share: float, limit: float) -> list[float]:
    """Split ``share`` of all sizes by weight; no part above ``limit`` times its size, the rest reshared by weight."""
    total, caps = share * sum(sizes), [limit * s for s in sizes]
    out, left, weight = [0.0] * len(sizes), total, sum(weights)
    for i in sorted(range(len(sizes)), key=lambda i: caps[i] / weights[i]):
        if caps[i] * weight <= left * weights[i]:
            out[i], left, weight = caps[i], left - caps[i], weight - weights[i]
        else:
            out[i] = -1.0
    return [left * weights[i] / weight if x < 0 else x for i, x in enumerate(out)]


@dataclass
class Mixture:
    """Per source (in code point order, null last): size, target, number of blocks, blocks to take."""

    sources: list
    sizes: list[int]
    targets: list[float]
    blocks: list[int]
    quotas: list[int]


def plan_mixture(sized: DataFrame, weights=WEIGHTS, share: float = 1.5, limit: float = 2.0, block_words: int = 128) -> Mixture:
    """Targets of all sources of ``sized(source, size)``; ``weights`` repeat over the ordered sources."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("n")).orderBy(F.col("source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"a mixture of more than {MAX_SOURCES} sources")
    sizes = [int(r["n"]) for r in rows]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(rows))], share, limit)
    blocks = [-(-n // block_words) for n in sizes]
    quotas = [min(int(limit * b), round(t * b / n)) if n else 0 for n, b, t in zip(sizes, blocks, targets)]
    return Mixture([r["source"] for r in rows], sizes, targets, blocks, quotas)


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of ``0 .. size - 1``, another one for every key: a Feistel network over the next
    power of four, walked on until the value is inside."""
    index, size, key = index.astype(np.uint64), size.astype(np.uint64), key.astype(np.uint64)
    half = np.ones(len(size), np.uint64)
    while (small := (np.uint64(1) << (2 * half)) < size).any():
        half[small] += np.uint64(1)
    mask, out, todo = (np.uint64(1) << half) - np.uint64(1), index.copy(), np.arange(len(index))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for turn in range(6):
            z = (right + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) ^ (k * np.uint64(0xD6E8FEB86659FD93))
            z ^= z >> np.uint64(32)
            z *= np.uint64(0xD6E8FEB86659FD93)
            z ^= z >> np.uint64(29)
            left, right = right, left ^ (z & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def slots(scratch: Scratch, plan: Mixture, seed: int, shard_blocks: int) -> DataFrame:
    """``(shard, place, block, pass_no)`` of every block taken; ``place`` is the source's number in the plan."""
    spark, quotas, blocks = scratch.spark, np.array(plan.quotas, np.int64), np.array(plan.blocks, np.int64)
    total = int(quotas.sum())
    shards = -(-total // shard_blocks)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                size = min(shard_blocks, total - shard * shard_blocks)
                counts = np.random.default_rng([seed, shard]).multinomial(size, quotas / total)
                place = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), shard)), pa.array(place), pa.array(counts[place])], ["shard", "place", "drawn"])

    drawn = scratch.cut(spark.range(shards).mapInArrow(draw, "shard long, place long, drawn long"), "drawn")
    numbered = stream_offsets(scratch, drawn.select(F.col("place").alias("source"), F.col("drawn").alias("size"), "shard"), ["source", "shard"], "draws")
    numbered = numbered.select("shard", F.col("source").alias("place"), F.col("size").alias("drawn"), F.col("offset").alias("first"))
    wanted = spark.createDataFrame([(i, int(q)) for i, q in enumerate(plan.quotas)], "place long, quota long")
    numbered = numbered.join(wanted, "place").select("shard", "place", "first", F.least("drawn", F.col("quota") - F.col("first")).alias("n"))
    sums = drawn.groupBy("place").agg(F.sum("drawn").alias("first"))
    settled = wanted.join(sums, "place", "left").select(F.lit(shards).alias("shard"), "place", F.coalesce("first", F.lit(0)).alias("first"), "quota")
    settled = settled.select("shard", "place", "first", (F.col("quota") - F.col("first")).alias("n"))
    takes = numbered.unionByName(settled).filter("n > 0").repartition(total // SLOTS_PER_TASK + 1, "shard", "place")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, place, first, n in zip(*(c.to_pylist() for c in batch.columns)):
                for at in range(first, first + n, 1 << 16):
                    index = np.arange(at, min(first + n, at + (1 << 16)))
                    size = np.full(len(index), blocks[place])
                    turn = index // size
                    block = permute(index % size, size, (turn * 1_000_003 + place) * 1_000_003 + seed)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(index), shard)), pa.array(np.full(len(index), place)), pa.array(block), pa.array(turn)], ["shard", "place", "block", "pass_no"])

    # written, so that joins are planned with the true size and not with that of the few rows it comes from
    return scratch.cut(takes.mapInArrow(spread, "shard long, place long, block long, pass_no long"), "slots")


def stream_offsets(scratch: Scratch, sized: DataFrame, order: list[str], name: str = "placed") -> DataFrame:
    """``sized`` with ``offset``, the words of its source before it: running sums inside the partitions of one range sort,
    plus the sums of the partitions before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, current, total = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            source = batch.column("source").to_pylist()
            offsets = []
            for name, size in zip(source, batch.column("size").to_pylist()):
                if name != current:
                    current, total = name, 0
                offsets.append(total)
                total += size
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(offsets), pa.int32()), pa.array(offsets, pa.int64())], [*batch.schema.names, "part", "inside"])

    schema = T.StructType([*sized.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("inside", T.LongType())])
    placed = scratch.cut(sized.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), name)
    sums = placed.groupBy(F.col("source").alias("_s"), F.col("part").alias("_p")).agg(F.sum("size").alias("_n"))
    before = Window.partitionBy("_s").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    out = placed.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("part") == F.col("_p")))
    return out.withColumn("offset", F.col("inside") + F.col("_before")).select(*sized.columns, "offset")


def takes(scratch: Scratch, sized: DataFrame, plan: Mixture, order: list[str], block_words: int, seed: int, shard_blocks: int) -> DataFrame:
    """``(row, block, begin, end, copies)``: the words ``begin .. end`` of a row that lie in a block, and how often the mix takes them.

    ``sized(row, source, size, ...)``; rows without words have no blocks.
    """
    names = scratch.spark.createDataFrame([(i, s) for i, s in enumerate(plan.sources)], sized.select(F.lit(0).cast("long").alias("place"), F.col("source").alias("_source")).schema)
    numbered = stream_offsets(scratch, sized.filter("size > 0"), ["source", *order]).join(names, F.col("source").eqNullSafe(F.col("_source")))
    last = F.col("offset") + F.col("size") - 1
    pieces = numbered.select("row", "place", "offset", "size", F.explode(F.sequence(F.floor(F.col("offset") / block_words), F.floor(last / block_words))).alias("block"))
    pieces = pieces.select(
        "row", "place", "block",
        F.greatest(F.lit(0), F.col("block") * block_words - F.col("offset")).alias("begin"),
        F.least(F.col("size"), (F.col("block") + 1) * block_words - F.col("offset")).alias("end"),
    )
    copies = slots(scratch, plan, seed, shard_blocks).groupBy("place", "block").agg(F.count(F.lit(1)).alias("copies"))
    return pieces.join(copies, ["place", "block"]).select("row", "block", "begin", "end", "copies")


def mix_report(
    docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text", weights=WEIGHTS, share: float = 1.5, limit: float = 2.0, block_words: int = 128, seed: int = 11, shard_blocks: int = 4096
) -> DataFrame:
    """``(id, size, source_size, target, taken)`` per row of ``docs``: its words, its source's words and target, and the words that
    the mix takes from it, repeats counted, never above ``limit`` times its size.

    Null and empty texts have size 0 and give nothing; null sources are one source, the last; repeated rows are rows of their own.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_column).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text).cast("string")).alias("hash"))
    rows = scratch.cut(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    plan = plan_mixture(rows, weights, share, limit, block_words)
    taken = takes(scratch, rows, plan, ["id", "hash", "row"], block_words, seed, shard_blocks)
    taken = taken.groupBy("row").agg(F.sum((F.col("end") - F.col("begin")) * F.col("copies")).alias("taken"))
    facts = scratch.spark.createDataFrame(list(zip(plan.sources, plan.sizes, plan.targets)), rows.select(F.col("source").alias("_source"), F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target")).schema)
    out = rows.join(taken, "row", "left").join(facts, F.col("source").eqNullSafe(F.col("_source")))
    return out.select(F.col("id").alias(id_column), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


_WORD = re.compile(WORD)


def taken_text(text: str, size: int, runs: list[tuple[int, int, int]]) -> str:
    """The words of all runs ``(begin, end, copies)``, first copies before second ones; touching runs stay one passage."""
    spans, parts = None, []
    for turn in range(1, max(c for *_, c in runs) + 1):
        joined: list[list[int]] = []
        for begin, end, copies in sorted(runs):
            if copies >= turn:
                if joined and joined[-1][1] == begin:
                    joined[-1][1] = end
                else:
                    joined.append([begin, end])
        for begin, end in joined:
            if (begin, end) == (0, size):
                parts.append(text)
                continue
            spans = spans or [m.span() for m in _WORD.finditer(text)]
            parts.append(text[spans[begin][0] : spans[end - 1][1]])
    return "\n".join(parts)


def mix(docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text", length: str | None = "n_chars", weights=WEIGHTS, share: float = 1.5, limit: float = 2.0, block_words: int = 128, seed: int = 11, shard_blocks: int = 4096) -> DataFrame:
    """The mix as rows of ``docs``: every row keeps the words that the mix takes from it, repeats after the first copies;
    rows that give nothing go. ``length`` names a column that is set to the new number of characters."""
    scratch = Scratch(docs.sparkSession)
    plain, name = numbered(docs)
    body = F.col(name[text])
    rows = scratch.cut(plain.withColumn("row", F.monotonically_increasing_id()).withColumn("size", word_count(body)).withColumn("hash", F.xxhash64(body.cast("string"))), "rows")
    sized = rows.select("row", F.col(name[id_column]).alias("id"), F.col(name[source]).alias("source"), "size", "hash")
    plan = plan_mixture(sized, weights, share, limit, block_words)
    runs = takes(scratch, sized, plan, ["id", "hash", "row"], block_words, seed, shard_blocks)
    runs = runs.groupBy("row").agg(F.collect_list(F.struct("begin", "end", "copies")).alias("runs"))
    joined = rows.join(runs, "row").select(*plain.columns, "size", "runs")
    place, width = docs.columns.index(text), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            values = [
                taken_text(t, n, [(r["begin"], r["end"], r["copies"]) for r in found])
                for t, n, found in zip(batch.column(place).cast(pa.string()).to_pylist(), batch.column(width).to_pylist(), batch.column(width + 1).to_pylist())
            ]
            columns = batch.columns[:width]
            columns[place] = pa.array(values, pa.string()).cast(columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:width])

    out = joined.mapInArrow(run, T.StructType(plain.schema.fields))
    if length and length in name:
        out = out.withColumn(name[length], F.length(body).cast(docs.schema[length].dataType))
    return out.toDF(*docs.columns)
