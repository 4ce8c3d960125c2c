"""Library-size normalisation and choice of variable genes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltrace.schema import CELL


def normalize_log1p(counts: DataFrame, target_sum: float = 1e4, log: bool = True, listed: list[str] | None = None) -> DataFrame:
    """Scale every cell to ``target_sum``, then ``log1p``. A cell with total 0 stays as it is.

    Totals are summed on the map side and joined back: no task sees all rows of a hot cell. ``listed`` names the columns that make a cell
    and gives one row for each of them, with its genes in ``entries array<struct<gene, x>>``: rows that already lie by cell are not shuffled.
    """

    def value(x: Column) -> Column:
        scaled = F.when(F.col("_total") == 0, x).otherwise(x * F.lit(float(target_sum)) / F.col("_total"))
        return F.log1p(scaled) if log else scaled

    if listed:
        cells = counts.groupBy(*listed).agg(F.sum("x").alias("_total"), F.collect_list(F.struct("gene", "x")).alias("entries"))
        return cells.withColumn("entries", F.transform("entries", lambda e: F.struct(e["gene"].alias("gene"), value(e["x"]).alias("x")))).drop("_total")
    totals = counts.groupBy(*CELL).agg(F.sum("x").alias("_total"))
    return counts.join(totals, CELL).withColumn("x", value(F.col("x"))).drop("_total")


def hvg_select(
    lognorm: DataFrame,
    cells: DataFrame,
    genes: DataFrame | None = None,
    *,
    group: list[str] | None = None,
    min_mean: float = 0.0125,
    max_mean: float = 3.0,
    min_disp: float = 0.5,
    n_bins: int = 20,
) -> DataFrame:
    """Dispersion-based variable genes: one row per gene with its flag.

    ``group`` runs the choice per batch in the same jobs. ``genes`` lists all genes, so that
    a gene without any stored value still counts in the mean range.
    """
    group = group or []
    e = F.expm1("x")
    sums = lognorm.groupBy(*group, "gene").agg(F.sum(e).alias("_s1"), F.sum(e * e).alias("_s2"))
    if genes is not None:
        sums = genes.join(sums, [*group, "gene"], "left").fillna(0.0, ["_s1", "_s2"])
    n_cells = cells.groupBy(*group).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    sums = sums.join(n_cells, group) if group else sums.withColumn("_n", n_cells.scalar())
    mean = F.col("_s1") / F.col("_n")
    stats = (
        sums.withColumn("_mean", mean)
        .withColumn("_var", (F.col("_s2") - F.col("_n") * F.col("_mean") * F.col("_mean")) / (F.col("_n") - 1))
        .withColumn("_mean", F.when(F.col("_mean") == 0, F.lit(1e-12)).otherwise(F.col("_mean")))
        .withColumn("_ratio", F.col("_var") / F.col("_mean"))
        .select(
            *group, "gene", F.log1p("_mean").alias("mean"),
            F.when(F.col("_ratio") > 0, F.ln("_ratio")).alias("dispersion"),
        )
    )
    span = stats.groupBy(*group).agg(F.min("mean").alias("_lo"), F.max("mean").alias("_hi"))
    spanned = stats.join(span, group) if group else stats.withColumn(
        "_lo", span.select("_lo").scalar()).withColumn("_hi", span.select("_hi").scalar())
    place = F.ceil(F.try_divide((F.col("mean") - F.col("_lo")) * n_bins, F.col("_hi") - F.col("_lo")))
    binned = spanned.withColumn("bin", F.greatest(F.lit(1), F.coalesce(place, F.lit(1)))).drop("_lo", "_hi")
    # A handful of bins, each a large share of the genes: aggregate and join back, no window per bin.
    per_bin = binned.groupBy(*group, "bin").agg(F.avg("dispersion").alias("_avg"), F.stddev_samp("dispersion").alias("_std"))
    lone = F.col("_std").isNull()
    norm = F.try_divide(
        F.col("dispersion") - F.when(lone, F.lit(0.0)).otherwise(F.col("_avg")),
        F.when(lone, F.col("_avg")).otherwise(F.col("_std")),
    )
    return (
        binned.join(per_bin, [*group, "bin"])
        .withColumn("dispersion_norm", F.coalesce(norm, F.lit(0.0)))
        .withColumn(
            "highly_variable",
            (F.col("mean") > min_mean) & (F.col("mean") < max_mean) & (F.col("dispersion_norm") > min_disp),
        )
        .select(*group, "gene", "mean", "dispersion", "bin", "dispersion_norm", "highly_variable")
    )


def keep_genes(matrix: DataFrame, genes: DataFrame, group: list[str] | None = None) -> DataFrame:
    keys = [*(group or []), "gene"]
    return matrix.join(genes.select(*keys), keys, "left_semi")
