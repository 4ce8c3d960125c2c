"""Numbers behind the figures: violin statistics, histogram, density curve, marker expression."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltrace.functions.scalars import renamed_group
from celltrace.operators.ordering import exact_quantiles
from celltrace.operators.qc import QUARTILES
from celltrace.schema import CELL

# Default marker genes, violin genes and the cluster names of the violin figure.
DEFAULT_MARKERS = ["Cdh5", "Ptprc", "Pecam1", "Emcn", "ZsGreen1", "Col1a2", "Runx1"]
VIOLIN_GENES = ["Cdh5", "Pecam1", "Kdr", "Flt1", "Cxcl12", "Pdgfrb", "Lepr", "Runx1", "Col1a2"]
CLUSTER_NAMES = {
    "0": "Endothelial cells",
    "1": "Endothelial cells",
    "13": "Endothelial cells",
    "22": "Endothelial cells",
    "14": "Mesenchymal type",
}


def group_labels(obs: DataFrame, cluster: str = "leiden", names: dict[str, str] | None = None) -> DataFrame:
    return obs.withColumn("group_labels", renamed_group(F.col(cluster).cast("string"), names or CLUSTER_NAMES))


def _summaries(values: DataFrame, group: list[str], value: str, totals: DataFrame | None) -> DataFrame:
    base = values.groupBy(*group).agg(
        F.count(value).alias("_stored"), F.sum(value).alias("_sum"), F.min(value).alias("_min"), F.max(value).alias("_max")
    )
    box = exact_quantiles(values, group, value, QUARTILES, totals)
    joined = box.join(base, group, "left").fillna(0, ["_stored"]).fillna(0.0, ["_sum"])
    has_zero = F.col("_stored") < F.col("n")
    low = F.when(has_zero, F.least(F.coalesce("_min", F.lit(0.0)), F.lit(0.0))).otherwise(F.col("_min"))
    high = F.when(has_zero, F.greatest(F.coalesce("_max", F.lit(0.0)), F.lit(0.0))).otherwise(F.col("_max"))
    return joined.select(
        *group, "n", (F.col("_sum") / F.col("n")).alias("mean"), low.alias("min"), "q1", "median", "q3", high.alias("max")
    )


def marker_violin_stats(lognorm: DataFrame, obs: DataFrame, genes: list[str], group: str = "group_labels") -> DataFrame:
    """Distribution of every gene in every cell group, zeros included. Only the
    stored values travel; the zeros are known from the group sizes."""
    cells = obs.filter(F.col(group).isNotNull()).select(*CELL, group)
    totals = cells.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    totals = totals.select(group, F.explode(F.array(*[F.lit(g) for g in genes])).alias("gene"), "n")
    values = lognorm.filter(F.col("gene").isin(genes)).join(cells, CELL).select(group, "gene", "x")
    return _summaries(values, [group, "gene"], "x", totals)


def qc_violin_stats(metrics: DataFrame) -> DataFrame:
    names = ["n_genes_by_counts", "total_counts", "pct_counts_mt"]
    long = metrics.select(*[F.col(n).cast("double").alias(n) for n in names]).unpivot([], names, "metric", "value")
    return _summaries(long, ["metric"], "value", None)


def qc_scatter(metrics: DataFrame) -> DataFrame:
    return metrics.select(*CELL, "total_counts", "pct_counts_mt", "n_genes_by_counts")


def score_histogram(scores: DataFrame, value: str, bins: int = 50, line: float | None = None) -> DataFrame:
    """Equal-width histogram with empty bins; the last bin holds its right edge.
    ``line`` adds the fraction of all values above it."""
    lo, hi = scores.agg(F.min(value).alias("lo")).scalar(), scores.agg(F.max(value).alias("hi")).scalar()
    place = F.floor(F.try_divide((F.col(value) - lo) * bins, hi - lo))
    counted = (
        scores.filter(F.col(value).isNotNull())
        .groupBy(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    axis = scores.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    out = axis.join(counted, "bin", "left").select(
        "bin", (lo + F.col("bin") * width).alias("left_edge"), F.coalesce("n", F.lit(0).cast("long")).alias("n")
    )
    if line is not None:
        above = scores.agg(F.avg(F.when(F.col(value) > line, 1.0).when(F.col(value).isNotNull(), 0.0)).alias("f")).scalar()
        out = out.withColumn("fraction_above_line", above)
    return out


def score_kde(scores: DataFrame, value: str, points: int = 200) -> DataFrame:
    """Gaussian density on an even grid with Scott's bandwidth. Every task adds its scores to a grid of its own and sends that
    on, so what is shuffled does not depend on the number of scores."""
    stats = scores.agg(
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).cast("double").alias("n"), F.stddev_samp(value).alias("sd")
    )
    one = stats.select(
        F.struct("lo", "hi", "n", (F.col("sd") * F.pow(F.col("n"), F.lit(-0.2))).alias("h")).alias("s")
    ).scalar()
    rows = scores.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("x"), one.alias("s"))
    rows = rows.select("x", "s.lo", "s.hi", "s.h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid, sums = None, np.zeros(points)
        for batch in batches:
            x, lo, hi, h = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for at in range(0, len(x), 4096):
                grid = lo[0] + np.arange(points) * (hi[0] - lo[0]) / (points - 1) if grid is None else grid
                z = (grid[:, None] - x[None, at : at + 4096]) / h[0]
                sums += np.exp(z * z * -0.5).sum(axis=1)
        if grid is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(points, dtype=np.int32)), pa.array(grid), pa.array(sums)], ["point", "at", "sum"])

    parts = rows.mapInArrow(run, "point int, at double, sum double").groupBy("point").agg(F.first("at").alias("at"), F.sum("sum").alias("_sum"))
    scale = parts.withColumn("s", one)
    return scale.select("point", "at", (F.col("_sum") / (F.col("s.n") * F.col("s.h") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))


def marker_expression(lognorm: DataFrame, cells: DataFrame, genes: list[str]) -> DataFrame:
    """Expression of the present markers in every cell (zeros filled in), beside the cell's own columns."""
    wanted = lognorm.filter(F.col("gene").isin(genes))
    per_cell = wanted.groupBy(*CELL).agg(F.map_from_entries(F.collect_list(F.struct("gene", "x"))).alias("_m"))
    grid = cells.join(per_cell, CELL, "left").withColumn("gene", F.explode(F.array(*[F.lit(g) for g in genes])))
    return grid.withColumn("x", F.coalesce(F.try_element_at("_m", F.col("gene")), F.lit(0.0))).drop("_m")


def markers_present(requested: DataFrame, genes: DataFrame) -> DataFrame:
    return requested.select("gene").join(genes.select("gene"), "gene", "left_semi")


def markers_missing(requested: DataFrame, genes: DataFrame) -> DataFrame:
    return requested.select("gene").join(genes.select("gene"), "gene", "left_anti")
