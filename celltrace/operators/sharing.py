"""How lineage barcodes are shared between cell types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltrace.functions.scalars import (
    DOUBLET_TYPE,
    NOT_TRUE_LABEL,
    TRUE_LABEL,
    TRUE_PGEN_CUTOFF,
    barcode_present,
    below_cutoff,
    count_class,
    lenient_double,
    not_doublet,
    strict_double,
    true_barcode_label,
)
from celltrace.operators.ordering import bounded_values, global_rank

ENDOTHELIAL = "Endothelial cells"
MESENCHYMAL = "Mesenchymal type"
HSPC = "HSPC"


def pgen_number(obs: DataFrame, strict: bool = False) -> Column:
    """``pgen`` as a number. In a text column bad values are missing, or an error if ``strict``."""
    if not isinstance(obs.schema["pgen"].dataType, T.StringType):
        return F.col("pgen")
    return strict_double("pgen") if strict else lenient_double("pgen")


def label_true_barcodes(obs: DataFrame, cutoff: float = TRUE_PGEN_CUTOFF) -> DataFrame:
    return obs.withColumn("true_bc", true_barcode_label(pgen_number(obs), cutoff))


def barcode_celltype_table(
    obs: DataFrame, cutoff: float = TRUE_PGEN_CUTOFF, doublets: str = "keep", strict: bool = False, present_only: bool = False
) -> DataFrame:
    """Cells per true barcode and cell type, long form, missing values left out.

    ``doublets``: ``keep``; ``drop_rows`` before counting, so that a barcode seen in
    doublets only disappears; ``drop_column`` after it (see ``celltype_combinations``).
    ``strict``: bad text in ``pgen`` is an error, as the ordered table asks for.
    ``present_only``: barcodes of the text ``nan`` are missing too, as the set counts ask for.
    """
    rows = obs.filter(below_cutoff(pgen_number(obs, strict), cutoff))
    if present_only:
        rows = rows.filter(barcode_present("barcode"))
    if doublets == "drop_rows":
        rows = rows.filter(not_doublet("cell_type"))
    rows = rows.dropna(subset=["barcode", "cell_type"])
    return rows.groupBy("barcode", "cell_type").agg(F.count(F.lit(1)).alias("n"))


def ordered_table(table: DataFrame) -> DataFrame:
    """Cell types by number of barcodes, barcodes by number of cell types, both
    descending with the name as last key; adds ``col_rank`` and ``row_rank``."""
    present = table.filter("n > 0")
    columns = global_rank(
        present.groupBy("cell_type").agg(F.count(F.lit(1)).alias("n_barcodes")),
        [F.desc("n_barcodes"), "cell_type"],
        "col_rank",
    )
    rows = global_rank(
        present.groupBy("barcode").agg(F.count(F.lit(1)).alias("n_cell_types")),
        [F.desc("n_cell_types"), "barcode"],
        "row_rank",
    )
    return table.join(columns, "cell_type").join(rows, "barcode")


def presence_counts(table: DataFrame) -> DataFrame:
    """Number of barcodes per cell type and of cell types per barcode."""
    present = table.filter("n > 0")
    by_type = present.groupBy(F.col("cell_type").alias("name")).agg(F.count(F.lit(1)).alias("n_present"))
    by_barcode = present.groupBy(F.col("barcode").alias("name")).agg(F.count(F.lit(1)).alias("n_present"))
    return by_type.withColumn("axis", F.lit("cell_type")).unionByName(by_barcode.withColumn("axis", F.lit("barcode")))


def linked_barcodes(table: DataFrame, target: str, require_other: bool) -> DataFrame:
    """Barcodes seen in ``target``, counted over every cell type of the whole table.

    The cell-type axis comes from the whole table, so types without a linked
    barcode stay as rows of zeros. The target is the first row, the others follow
    by total; barcodes follow by total. A missing target gives an empty table.
    """
    types = bounded_values(table, "cell_type")
    per_barcode = table.groupBy("barcode").agg(
        F.sum(F.when(F.col("cell_type") == target, F.col("n")).otherwise(0)).alias("_target"),
        F.sum(F.when(F.col("cell_type") != target, F.col("n")).otherwise(0)).alias("_other"),
        F.sum("n").alias("col_total"),
        F.map_from_entries(F.collect_list(F.struct("cell_type", "n"))).alias("_counts"),
    )
    linked = per_barcode.filter("_target > 0")
    if require_other:
        # With the target as the only cell type there is nothing to be linked to: keep all.
        linked = linked.filter((F.col("_other") > 0) | (F.size(types) <= 1))
    columns = global_rank(linked.select("barcode", "col_total", "_counts"), [F.desc("col_total"), "barcode"], "col_rank")
    grid = columns.withColumn("cell_type", F.explode(types)).withColumn(
        "n", F.coalesce(F.try_element_at("_counts", F.col("cell_type")), F.lit(0).cast("long"))
    )
    totals = grid.groupBy("cell_type").agg(F.sum("n").alias("row_total"))
    rows = global_rank(
        totals, [F.when(F.col("cell_type") == target, 0).otherwise(1), F.desc("row_total"), "cell_type"], "row_rank"
    )
    return grid.join(rows, "cell_type").select(
        "cell_type", "barcode", "n", "row_total", "col_total", "row_rank", "col_rank", count_class("n").alias("class")
    )


def barcode_any_true(obs: DataFrame) -> DataFrame:
    """One label per barcode: true if any of its cells is true."""
    rows = obs.dropna(subset=["barcode", "true_bc"])
    any_true = F.bool_or(F.col("true_bc") == TRUE_LABEL)
    return rows.groupBy("barcode").agg(F.when(any_true, TRUE_LABEL).otherwise(NOT_TRUE_LABEL).alias("true_bc"))


def plottable_cells(obs: DataFrame) -> DataFrame:
    """Cells with a barcode that are no doublets."""
    return obs.filter(not_doublet("cell_type") & barcode_present("barcode"))


def barcode_list_page(labels: DataFrame, ncols: int = 5) -> DataFrame:
    """Place of every barcode on a page of ``ncols`` columns, filled column by column in text order."""
    ranked = global_rank(labels, ["barcode"], "position")
    n = ranked.agg(F.count(F.lit(1)).alias("n")).scalar()
    per_column = F.ceil(n / F.lit(ncols))
    index = F.col("position") - 1
    return ranked.select(
        "barcode",
        "true_bc",
        F.floor(index / per_column).alias("page_col"),
        (index % per_column).alias("page_row"),
    )


def celltype_sets(table: DataFrame, priority: str = ENDOTHELIAL) -> DataFrame:
    """Cell types of every barcode, ``priority`` first, the others as text. A barcode seen in doublets only keeps an empty set."""
    kind = F.when((F.col("cell_type") != DOUBLET_TYPE) & (F.col("n") > 0), F.col("cell_type"))
    ordered = F.array_sort(F.collect_set(F.when(kind.isNotNull(), F.struct((kind != priority).alias("later"), kind.alias("name")))))
    return table.groupBy("barcode").agg(F.transform(ordered, lambda x: x["name"]).alias("cell_types"))


def celltype_combinations(table: DataFrame, priority: str = ENDOTHELIAL) -> DataFrame:
    """Number of barcodes per exact combination of cell types, with its place by degree, then number, then text."""
    sets = celltype_sets(table, priority).groupBy("cell_types").agg(F.count(F.lit(1)).alias("n"))
    sets = sets.withColumn("degree", F.size("cell_types")).withColumn("_text", F.array_join("cell_types", ", "))
    return global_rank(sets, ["degree", F.desc("n"), "_text"], "place").drop("_text")


def celltype_barcode_totals(table: DataFrame) -> DataFrame:
    present = table.filter((F.col("n") > 0) & (F.col("cell_type") != DOUBLET_TYPE))
    return present.groupBy("cell_type").agg(F.count(F.lit(1)).alias("n_barcodes"))


def presence_class(cell_types: Column | str, a: str = MESENCHYMAL, b: str = ENDOTHELIAL) -> Column:
    names = F.col(cell_types) if isinstance(cell_types, str) else cell_types
    has_a, has_b = F.array_contains(names, a), F.array_contains(names, b)
    return (
        F.when(has_a & has_b, "both").when(has_a, f"only {a}").when(has_b, f"only {b}").otherwise("other")
    )
