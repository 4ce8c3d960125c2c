"""The working tables, derived by Spark from the given star-schema tables.

Barcode side: a cell is an order, its sample the customer's nation, its
candidate barcodes the brand/type/size keys of the order's line items.
Count side: a cell is a customer, a gene a part, a count the quantity bought.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celltrace.operators import barcodes, normalize, qc
from celltrace.session import cut

QC_LIMITS = {"min_genes": 20, "min_counts": 500, "min_cells": 20, "max_genes": 60, "max_pct_mt": 20.0}
HVG_MAX_MEAN = 5.0
MARKERS = [f"g{i}" for i in range(12)]
TARGETS = {"hspc": "HSPC", "endothelial": "Endothelial cells", "mesenchymal": "Mesenchymal type"}


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


class Tables:
    """Lazy views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.opened: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.opened[name]

    @cached_property
    def lines(self) -> DataFrame:
        """Line items. A table of fewer files than cores is spread by the join key first, because a
        file of one row group is read by one task; a large table never is."""
        table = self.read("lineitem")
        cores = self.spark.sparkContext.defaultParallelism
        return table.repartition(cores, "l_orderkey") if len(table.inputFiles()) < cores else table

    def keep(self, *names: str) -> Tables:
        """Write the named tables once; for queries that use them several times."""
        for name in names:
            self.__dict__[name] = cut(getattr(self, name))
        return self

    # ---- barcode side ----

    @cached_property
    def cells(self) -> DataFrame:
        kind = (
            F.when(F.col("o_custkey") % 13 == 0, F.lit(None).cast("string"))
            .when(F.col("c_mktsegment") == "MACHINERY", "Doublets")
            .when(F.col("c_mktsegment") == "HOUSEHOLD", "HSPC")
            .when(F.col("c_mktsegment") == "AUTOMOBILE", "Endothelial cells")
            .when(F.col("c_mktsegment") == "BUILDING", "Mesenchymal type")
            .otherwise(F.col("c_mktsegment"))
        )
        order_text = F.lpad(text("o_orderkey"), 12, "0")
        return (
            self.read("orders")
            .join(self.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select(
                text("c_nationkey").alias("sample"),
                F.concat(F.lit("c"), order_text, F.lit("-"), text(F.col("o_orderkey") % 3)).alias("cell"),
                kind.alias("cell_type"),
            )
        )

    @cached_property
    def sample_mouse(self) -> DataFrame:
        """Region 4 is left out of the map, so its samples have no mouse."""
        return (
            self.read("nation")
            .filter("n_regionkey <> 4")
            .select(text("n_nationkey").alias("sample"), F.concat(F.lit("Mouse#"), text("n_regionkey")).alias("mouse"))
        )

    @staticmethod
    def barcode_text() -> Column:
        return F.concat_ws("_", "p_brand", "p_type", text(F.col("p_size") % 10))

    @cached_property
    def library_lines(self) -> DataFrame:
        """One line per part, so barcodes repeat; one brand is absent from the library."""
        return self.read("part").filter("p_brand <> 'Brand#7'").select(
            F.col("p_partkey").alias("line_no"), F.concat(F.lit(" "), F.lower(self.barcode_text()), F.lit("\t")).alias("barcode")
        )

    @cached_property
    def mincut_lines(self) -> DataFrame:
        size = text("p_size")
        bad = F.when(F.col("p_size") % 7 == 0, "x").when(F.col("p_size") % 5 == 0, F.concat(size, F.lit(".7"))).otherwise(size)
        return self.read("part").select(F.col("p_partkey").alias("line_no"), bad.alias("mincut"))

    @cached_property
    def library(self) -> DataFrame:
        return barcodes.barcode_library(self.library_lines, self.mincut_lines)

    @cached_property
    def rare_wide(self) -> DataFrame:
        """One line per part and one pGen column per sample; some are empty, some are no numbers."""
        samples = [r[0] for r in self.read("nation").select("n_nationkey").orderBy("n_nationkey").collect()]
        value = "CASE WHEN (p_partkey + {0}) % 11 = 0 THEN NULL WHEN (p_partkey + {0}) % 17 = 0 THEN 'bad' ELSE concat('5e-', (p_partkey + {0}) % 12) END AS `{0}`"
        key = "lower(concat_ws('_', p_brand, p_type, p_size % 10)) AS Barcode"
        return self.read("part").selectExpr("p_partkey AS line_no", "CAST(NULL AS STRING) AS PolyloxBC", key, *[value.format(j) for j in samples])

    @cached_property
    def rare(self) -> DataFrame:
        return barcodes.rare_pgen_long(self.rare_wide, "Barcode")

    @cached_property
    def assemblies(self) -> DataFrame:
        """Every line item is one candidate of its order's cell."""
        return (
            self.lines.join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.read("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                text("c_nationkey").alias("sample"),
                F.concat(F.lit("\tc"), F.lpad(text("l_orderkey"), 12, "0")).alias("cb"),
                F.concat(F.lower(self.barcode_text()), F.lit(" ")).alias("polylox"),
            )
        )

    @cached_property
    def candidates(self) -> DataFrame:
        return barcodes.candidate_barcodes(self.assemblies, self.sample_mouse, self.library, self.rare)

    @cached_property
    def assigned(self) -> DataFrame:
        return barcodes.barcode_assign(
            self.cells, self.assemblies, self.sample_mouse, self.library, self.rare, order="polylox"
        )

    # ---- count side ----

    @cached_property
    def genes_of_parts(self) -> DataFrame:
        prefix = F.when(F.col("p_name").startswith("red "), "mt-").otherwise("g")
        return self.read("part").select("p_partkey", F.concat(prefix, text("p_partkey")).alias("gene"), "p_brand", "p_type")

    @cached_property
    def cells_of_orders(self) -> DataFrame:
        """Orders meet their customers first, so that line items are shuffled for orders and parts only."""
        joined = self.read("orders").join(self.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return joined.select("o_orderkey", text("c_nationkey").alias("sample"), text("o_custkey").alias("cell"))

    @cached_property
    def counts(self) -> DataFrame:
        return (
            self.lines.join(self.cells_of_orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.genes_of_parts, F.col("l_partkey") == F.col("p_partkey"))
            .groupBy("sample", "cell", "gene")
            .agg(F.sum("l_quantity").alias("x"))
        )

    @cached_property
    def clusters(self) -> DataFrame:
        number = {"AUTOMOBILE": "0", "FURNITURE": "1", "HOUSEHOLD": "22", "BUILDING": "14", "MACHINERY": "7"}
        pairs = [F.lit(v) for kv in number.items() for v in kv]
        return self.read("customer").select(
            text("c_nationkey").alias("sample"),
            text("c_custkey").alias("cell"),
            F.try_element_at(F.create_map(*pairs), F.col("c_mktsegment")).alias("leiden"),
        )

    @cached_property
    def passed(self) -> DataFrame:
        """Counts after both cell floors."""
        return qc.filter_cells(self.counts, QC_LIMITS["min_genes"], QC_LIMITS["min_counts"])

    @cached_property
    def filtered(self) -> DataFrame:
        """Counts after both cell floors and the gene floor."""
        return qc.filter_genes(self.passed, QC_LIMITS["min_cells"])

    @cached_property
    def metrics(self) -> DataFrame:
        return qc.cell_metrics(self.filtered)

    @cached_property
    def good_cells(self) -> DataFrame:
        return qc.qc_hard_filter(self.metrics, QC_LIMITS["max_genes"], QC_LIMITS["max_pct_mt"])

    @cached_property
    def good_counts(self) -> DataFrame:
        return qc.keep_cells(self.filtered, self.good_cells)

    @cached_property
    def genes(self) -> DataFrame:
        return self.filtered.select("gene").distinct()

    @cached_property
    def lognorm(self) -> DataFrame:
        return normalize.normalize_log1p(self.good_counts)

    @cached_property
    def net(self) -> DataFrame:
        return self.genes_of_parts.select(F.col("p_brand").alias("cell_type"), F.col("gene").alias("genesymbol"))

    def gene_set(self, p_type: str) -> DataFrame:
        return self.genes_of_parts.filter(F.col("p_type") == p_type).select("gene")

    @cached_property
    def marker_request(self) -> DataFrame:
        return self.spark.createDataFrame([(g,) for g in MARKERS], "gene string")

    # ---- vector side ----

    @cached_property
    def vectors(self) -> DataFrame:
        return self.read("embeddings").select(
            F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), F.col("label").cast("string").alias("label")
        )
