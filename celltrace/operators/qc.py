"""Merging count matrices, cell and gene quality metrics, and filters.

Counts are long rows ``(sample, cell, gene, x)`` with zeros left out, so every
mean divides by the number of cells, never by the number of stored rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltrace.functions.scalars import is_mitochondrial
from celltrace.operators.ordering import bounded_values, exact_quantiles, rank_in_group
from celltrace.schema import CELL

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def merge_samples(parts: list[DataFrame]) -> DataFrame:
    """Outer union over genes: a gene missing in a sample is an implicit zero there."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def merge_gene_metadata(parts: list[DataFrame], column: str) -> DataFrame:
    """Keep a gene's value only where all samples that have the gene agree."""
    rows = reduce(lambda a, b: a.unionByName(b), [p.select("gene", column) for p in parts])
    low, high = F.min(column), F.max(column)
    return rows.groupBy("gene").agg(F.when(low == high, low).alias(column))


def unique_names(names: DataFrame, name: str = "name", order: str = "idx", group: list[str] | None = None) -> DataFrame:
    """First holder keeps a name; later ones get ``-1``, ``-2``, ... skipping texts already in use.

    The i-th free number of a name is i plus the count of used numbers before
    it. Merging repeats (key i) with used numbers (key t - rank) in one sorted list
    gives that number as the place of the repeat. ``group`` keeps lists apart.
    """
    g = group or []
    ranked = rank_in_group(names.select(*g, order, name), [*g, name], [order], "_nth")
    first = ranked.filter("_nth = 1").select(*g, order, name, F.col(name).alias("unique_name"))
    repeats = ranked.filter("_nth > 1").select(*g, order, F.col(name).alias("_base"), (F.col("_nth") - 1).alias("_key"))
    numbered = r"^(?s)(.*)-([1-9][0-9]{0,17})$"
    suffix = F.regexp_extract(name, numbered, 2)
    used = (
        ranked.filter("_nth = 1")
        .filter(suffix != "")
        .select(*g, F.regexp_extract(name, numbered, 1).alias("_base"), suffix.cast("long").alias("_t"))
        .join(repeats.select(*g, "_base").distinct(), [*g, "_base"], "left_semi")
    )
    used = rank_in_group(used, [*g, "_base"], ["_t"], "_r").select(
        *g, F.lit(None).cast(names.schema[order].dataType).alias(order), "_base", (F.col("_t") - F.col("_r")).alias("_key"), F.lit(1).alias("_kind"), "_t"
    )
    repeats = repeats.withColumn("_kind", F.lit(0)).withColumn("_t", F.lit(None).cast("long"))
    # A used number counts only when its key is below the repeat's: with equal keys the repeat comes first.
    merged = rank_in_group(repeats.unionByName(used), [*g, "_base"], ["_key", "_kind", "_t"], "_no")
    renamed = merged.filter("_kind = 0").select(
        *g, order, F.col("_base").alias(name), F.concat_ws("-", "_base", F.col("_no").cast("string")).alias("unique_name")
    )
    return first.unionByName(renamed)


def with_cell_totals(counts: DataFrame) -> DataFrame:
    """Adds genes and counts per cell. The totals are summed before the shuffle and joined
    back, so that a cell holding a large share of the rows is split like any skewed join key."""
    totals = counts.groupBy(*CELL).agg(F.count_if(F.col("x") > 0).alias("n_genes"), F.sum("x").alias("n_counts"))
    return counts.join(totals, CELL)


def filter_cells(counts: DataFrame, min_genes: int = 200, min_counts: float | None = None) -> DataFrame:
    """Both cell floors see the same unfiltered genes, so one pass serves the two."""
    totals = counts.groupBy(*CELL).agg(F.count_if(F.col("x") > 0).alias("n_genes"), F.sum("x").alias("n_counts"))
    kept = totals.filter(F.col("n_genes") >= min_genes)
    if min_counts is not None:
        kept = kept.filter(F.col("n_counts") >= min_counts)
    return keep_cells(counts, kept)


def filter_genes(counts: DataFrame, min_cells: int = 3) -> DataFrame:
    """Genes found in enough of the *remaining* cells; run after the cell filters."""
    genes = counts.groupBy("gene").agg(F.count_if(F.col("x") > 0).alias("_n")).filter(F.col("_n") >= min_cells)
    return counts.join(genes.select("gene"), "gene", "left_semi")


def cell_metrics(counts: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """Genes, counts, mitochondrial counts and percentage per cell. ``cells`` adds
    those without any stored count."""
    per_cell = counts.groupBy(*CELL).agg(
        F.count_if(F.col("x") > 0).alias("n_genes_by_counts"),
        F.sum("x").alias("total_counts"),
        F.sum(F.when(is_mitochondrial("gene"), F.col("x")).otherwise(0.0)).alias("total_counts_mt"),
    )
    if cells is not None:
        per_cell = cells.select(*CELL).join(per_cell, CELL, "left").fillna(0, ["n_genes_by_counts", "total_counts", "total_counts_mt"])
    return per_cell.withColumn("pct_counts_mt", F.try_divide(F.col("total_counts_mt") * 100.0, F.col("total_counts")))


def gene_metrics(counts: DataFrame, cells: DataFrame, genes: DataFrame | None = None) -> DataFrame:
    n = cells.agg(F.count(F.lit(1)).alias("n")).scalar()
    per_gene = counts.groupBy("gene").agg(
        F.count_if(F.col("x") > 0).alias("n_cells_by_counts"), F.sum("x").alias("total_counts")
    )
    if genes is not None:
        per_gene = genes.select("gene").join(per_gene, "gene", "left").fillna(0, ["n_cells_by_counts", "total_counts"])
    return (
        per_gene.withColumn("mean_counts", F.col("total_counts") / n)
        .withColumn("pct_dropout_by_counts", (1.0 - F.col("n_cells_by_counts") / n) * 100.0)
    )


def qc_hard_filter(metrics: DataFrame, max_genes: int = 8000, max_pct_mt: float = 10.0) -> DataFrame:
    return metrics.filter((F.col("n_genes_by_counts") < max_genes) & (F.col("pct_counts_mt") < max_pct_mt))


def drop_predicted_doublets(obs: DataFrame) -> DataFrame:
    """Only where cells were scored at all; a cell without a flag is no predicted doublet."""
    return obs.filter(~F.coalesce("predicted_doublet", F.lit(False))) if "predicted_doublet" in obs.columns else obs


def keep_cells(counts: DataFrame, cells: DataFrame) -> DataFrame:
    return counts.join(cells.select(*CELL), CELL, "left_semi")


def top_expressed_genes(counts: DataFrame, cells: DataFrame, n_top: int = 20) -> DataFrame:
    """Genes with the highest mean share of a cell's counts, with the box of that share over all cells."""
    n_cells = cells.agg(F.count(F.lit(1)).alias("n"))
    shares = with_cell_totals(counts).select(*CELL, "gene", F.try_divide(F.col("x") * 100.0, F.col("n_counts")).alias("pct"))
    means = shares.groupBy("gene").agg((F.sum("pct") / n_cells.scalar()).alias("mean_pct"), F.max("pct").alias("max_pct"))
    top = means.orderBy(F.desc("mean_pct"), "gene").limit(n_top)
    top = top.withColumn("n", n_cells.scalar())
    box = exact_quantiles(shares.join(top.select("gene"), "gene", "left_semi"), ["gene"], "pct", QUARTILES, top.select("gene", "n"))
    return top.drop("n").join(box, "gene")


def cluster_sample_counts(obs: DataFrame, cluster: str = "leiden") -> DataFrame:
    """Cells per cluster and sample with zeros filled in and the cluster total, long form."""
    seen = obs.filter(F.col(cluster).isNotNull()).groupBy(cluster, "sample").agg(F.count(F.lit(1)).alias("n"))
    clusters = seen.groupBy(cluster).agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("sample", "n"))).alias("_n")
    )
    grid = clusters.withColumn("sample", F.explode(bounded_values(seen, "sample")))
    return grid.select(cluster, "sample", F.coalesce(F.try_element_at("_n", F.col("sample")), F.lit(0).cast("long")).alias("n"), "total")


def cluster_sample_wide(obs: DataFrame, samples: list[str], cluster: str = "leiden") -> DataFrame:
    """The same as one row per cluster and one column per named sample."""
    wide = obs.groupBy(cluster).pivot("sample", samples).count().na.fill(0)
    return wide.withColumn("total", reduce(lambda a, b: a + b, [F.col(f"`{s}`") for s in samples]))
