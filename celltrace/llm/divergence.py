"""Divergence audit: how far the sources of a language differ in their term probabilities, by three-dimensional cube partitioning.

The cube has the sources of a language on two axes and its kept terms on the third. A task owns a cell (block of sources, block of
sources, block of terms): it gets the slices of both blocks of sources that lie in its block of terms, every slice replicated to
all cells that need it, and sums the differences of all pairs of sources over its terms. A grouped sum then reduces the cells along
the term axis. A cell reads its rows in the order of the terms, so it holds one batch of terms and one number per pair, however many terms
a block has.

All numbers are integers. Counting is pre-aggregated in the tasks that read the texts, so a hot source or a frequent term sends
a few rows per task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from celltrace.llm.scratch import Scratch

#: Sources and terms of one block of the cube.
SOURCE_BLOCK, TERM_BLOCK = 16, 1024
#: Documents of a language that a kept term is in, at least; what is added to every count; the probability of 1.
LEAST_DOCUMENTS, PRIOR, UNIT = 30, 5, 1_000_000_000
#: Distinct terms that a counting task gathers before it passes its counts on.
_HELD = 1 << 18
_SLICE = 1 << 20

# Bytes that are no part of a term become blanks, A-Z become a-z.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else 0x20 if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256)
)


def terms(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a UTF-8 text, slice by slice; a slice ends at a blank."""
    at = 0
    while at < len(text):
        part = text[at : at + _SLICE].translate(_FOLD)
        end = at + len(part)
        if end < len(text):
            cut = part.rfind(b" ")
            if cut >= 0:
                part, end = part[:cut], at + cut
            else:  # a long term goes on
                pieces = [part]
                while end < len(text):
                    more = text[end : end + _SLICE].translate(_FOLD)
                    stop = more.find(b" ")
                    pieces.append(more if stop < 0 else more[:stop])
                    end += len(pieces[-1])
                    if stop >= 0:
                        break
                part = b"".join(pieces)
        yield part.split()
        at = max(end, at + 1)


def count_terms(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)`` of ``docs(lang, source, text)``: occurrences and documents; partial sums, to be added up.
    Every document's group also has a row with a null term."""
    names = ["lang", "source", "term", "n", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = {}

        def flush():
            for (lang, source), (times, docs_) in groups.items():
                keys = list(times)
                for at in range(0, len(keys) + 1, 1 << 14):
                    part = keys[at : at + (1 << 14)]
                    tail = [None] if at + (1 << 14) > len(keys) else []
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * (len(part) + len(tail)), pa.string()), pa.array([source] * (len(part) + len(tail)), pa.string()),
                            pa.array(part + tail, pa.binary()), pa.array([times[t] for t in part] + [0] * len(tail), pa.int64()), pa.array([docs_[t] for t in part] + [0] * len(tail), pa.int64()),
                        ], names,
                    )
            groups.clear()

        for batch in batches:
            langs, sources, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            for lang, source, text in zip(langs, sources, texts):
                times, docs_ = groups.setdefault((lang, source), (Counter(), Counter()))
                body, seen = text.as_py(), set()
                for found in terms(body):
                    times.update(found)
                    seen.update(found)
                docs_.update(seen)
                if len(times) > _HELD:
                    yield from flush()
            if sum(len(t) for t, _ in groups.values()) > _HELD:
                yield from flush()
        yield from flush()

    return docs.select("lang", "source", F.col("text").cast("binary")).mapInArrow(run, "lang string, source string, term binary, n long, docs long")


def partial_divergences(cells: DataFrame) -> DataFrame:
    """``(a, b, value)``: for every cell and every pair of its sources the sum of ``|p - q|`` over the terms of the cell.

    ``cells(lang, low, high, block, term, upper, source, p, size)`` come as slices; a null ``term`` tells a source of the cell with the
    ``p`` of a term that it does not have, and how many terms the block has. ``upper``: the slice of block ``high``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rest = None, None
        sides = {False: [], True: []}
        state: dict = {}

        def add(term: np.ndarray, upper: np.ndarray, source: np.ndarray, p: np.ndarray) -> None:
            """Terms of the open cell, each with all its rows."""
            if "sums" not in state:
                state["ids"] = {s: np.array([x for x, _ in sides[s]], np.int64) for s in sides}
                state["base"] = {s: np.array([x for _, x in sides[s]], np.int64) for s in sides}
                state["same"] = now[0][1] == now[0][2]
                if state["same"]:
                    state["ids"][True], state["base"][True] = state["ids"][False], state["base"][False]
                state["order"] = {s: np.argsort(state["ids"][s]) for s in sides}
                state["sums"], state["seen"] = np.zeros((len(state["ids"][False]), len(state["ids"][True])), np.int64), 0
            if not len(term):
                return
            names, column = np.unique(term, return_inverse=True)
            state["seen"] += len(names)
            grids = {}
            for side in (False,) if state["same"] else (False, True):
                mine = upper == side
                order = state["order"][side]
                row = order[np.searchsorted(state["ids"][side], source[mine], sorter=order)]
                grid = np.repeat(state["base"][side][:, None], len(names), axis=1)
                grid[row, column[mine]] = p[mine]
                grids[side] = grid
            other = grids.get(True, grids[False])
            for i, line in enumerate(grids[False]):
                state["sums"][i] += np.abs(other - line).sum(axis=1)

        def close():
            if now is None:
                return
            add(*(rest if rest is not None else [np.empty(0, np.int64)] * 4))
            low, high, size = state["base"][False], state["base"][True], now[-1]
            sums = state["sums"] + np.abs(low[:, None] - high[None, :]) * (size - state["seen"])
            a, b = (x.ravel() for x in np.meshgrid(state["ids"][False], state["ids"][True], indexing="ij"))
            keep = a < b if state["same"] else np.ones(len(a), bool)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[keep]), pa.array(np.maximum(a, b)[keep]), pa.array(sums.ravel()[keep])], ["a", "b", "value"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(4))))
            told = batch.column("term").is_null().to_numpy(zero_copy_only=False)
            term = batch.column("term").fill_null(-1).to_numpy()
            upper = batch.column("upper").to_numpy(zero_copy_only=False)
            source, p, size = (batch.column(c).to_numpy() for c in ("source", "p", "size"))
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for start, end in zip(edges[:-1], edges[1:]):
                if now is None or now[0] != keys[start]:
                    yield from close()
                    now, rest, state = (keys[start], int(size[start])), None, {}
                    sides = {False: [], True: []}
                for i in range(start, end):
                    if not told[i]:
                        break
                    sides[bool(upper[i])].append((int(source[i]), int(p[i])))
                    start += 1
                if start == end:
                    continue
                rows = [x[start:end] for x in (term, upper, source, p)]
                rows = rows if rest is None else [np.concatenate(pair) for pair in zip(rest, rows)]
                last = int(np.searchsorted(rows[0], rows[0][-1]))  # its other rows may be in the next batch
                if last:
                    add(*(x[:last] for x in rows))
                rest = [x[last:] for x in rows]
        yield from close()

    cell = ["lang", "low", "high", "block"]
    rows = cells.select(*cell, "term", "upper", "source", "p", "size").repartition(*cell).sortWithinPartitions(*cell, F.col("term").asc_nulls_first())
    return rows.mapInArrow(run, "a long, b long, value long")


def share(count: Column, total: Column, unit: int) -> Column:
    """``1 + floor(unit * count / total)``, exactly; null where there is nothing."""
    return F.when(total > 0, F.call_function("div", count.cast("decimal(20,0)") * F.lit(unit).cast("decimal(12,0)"), total) + 1)


def divergences(
    docs: DataFrame, group: str = "lang", member: str = "source", text: str = "text",
    least: int = LEAST_DOCUMENTS, prior: int = PRIOR, unit: int = UNIT, top: int = 50, scratch: Scratch | None = None,
) -> DataFrame:
    """``(group, member, part, item, value, rank)`` of all rows of ``docs``.

    Part ``pair``: every other member of the group by the sum of ``|p - q|`` over all kept terms. Part ``term``: the ``top`` kept terms that
    a member has and uses more than its group does. Kept are the terms in ``least`` documents of a group at least; ``p`` is
    ``1 + floor(unit * (count + prior) / (all + prior * terms))``. Nulls are empty texts and names; groups without kept terms have pairs
    with value 0; repeated rows are documents of their own; equal values go by the item's bytes. Other columns of ``docs`` are not read.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    clean = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((group, "lang"), (member, "source"), (text, "text"))))
    counts = count_terms(clean).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = scratch.cut(counts, "counts")

    # the axes: kept terms and sources, each with its number and block
    kept = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("whole"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least)
    kept = scratch.cut(kept.select("lang", "term", "whole").withColumn("no", F.monotonically_increasing_id()), "kept")
    used = scratch.cut(counts.filter("term is not null").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "whole", "no"), "used")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("whole").alias("all"))
    members = counts.filter("term is null").select("lang", "source")
    sizes = used.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    per_lang = members.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(langs, "lang", "left").fillna(0, ["terms", "all"])
    per_lang = per_lang.select("lang", "terms", "all", F.ceil(F.col("sources") / SOURCE_BLOCK).alias("parts"), F.greatest(F.ceil(F.col("terms") / TERM_BLOCK), F.lit(1)).alias("blocks"))
    members = members.join(sizes, ["lang", "source"], "left").fillna(0, ["n"]).join(per_lang, "lang")
    members = members.select(
        "lang", "source", "parts", "blocks", "all", "terms", (F.col("n") + prior * F.col("terms")).alias("total"), F.pmod(F.xxhash64("source"), "parts").alias("part"),
    ).withColumn("id", F.monotonically_increasing_id())
    members = scratch.cut(members, "members")

    # the slices, replicated to the cells of their row and column of blocks
    facts = used.join(members, ["lang", "source"]).withColumn("p", share(F.col("n") + prior, F.col("total"), unit))
    facts = scratch.cut(facts.withColumn("block", F.pmod(F.xxhash64("no"), "blocks")).select("lang", "source", "term", "no", "whole", "all", "terms", "p", "id", "part", "parts", "block"), "facts")
    filled = kept.join(per_lang.select("lang", "blocks"), "lang").groupBy("lang", F.pmod(F.xxhash64("no"), "blocks").alias("block")).agg(F.count(F.lit(1)).alias("size"))
    told = members.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).join(filled, ["lang", "block"], "left").fillna(0, ["size"])
    told = told.select("lang", "part", "parts", "block", F.lit(None).cast("long").alias("term"), F.col("id").alias("source"), F.coalesce(share(F.lit(prior), F.col("total"), unit), F.lit(0).cast("long")).alias("p"), "size")
    slices = told.unionByName(facts.select("lang", "part", "parts", "block", F.col("no").alias("term"), F.col("id").alias("source"), "p", F.lit(0).cast("long").alias("size")))
    cells = slices.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    cells = cells.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other")).withColumn("upper", F.col("part") > F.col("other"))
    sums = scratch.cut(partial_divergences(cells).groupBy("a", "b").agg(F.sum("value").alias("value")), "sums")

    both = sums.select("a", "b", "value").union(sums.select("b", "a", "value"))
    one, two = members.select(F.col("id").alias("a"), "lang", "source"), members.select(F.col("id").alias("b"), F.col("source").alias("item"))
    pairs = both.join(one, "a").join(two, "b").select("lang", "source", "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    more = facts.withColumn("value", F.col("p") - share(F.col("whole") + prior, F.col("all") + prior * F.col("terms"), unit)).filter("value > 0")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("term"))  # every map task sends its first rows only
    more = more.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    more = more.select("lang", "source", F.col("term").cast("string").alias("item"), "value", "rank", F.lit("term").alias("part"))
    out = pairs.unionByName(more)
    return out.select(F.col("lang").alias(group), F.col("source").alias(member), "part", "item", "value", "rank")
