"""From counts to clusters and annotated cells: the single steps in the order of an analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltrace.operators import cycle, doublets, graph, markers, matrix, normalize, qc
from celltrace.schema import CELL
from celltrace.session import cut


def cluster_cells(
    counts: DataFrame,
    cells: DataFrame,
    genes: DataFrame,
    max_mean: float = 3.0,
    components: int = 40,
    neighbours: int = 10,
    resolution: float = 0.8,
) -> DataFrame:
    """``(sample, cell, leiden)`` of all ``cells`` that are no predicted doublets: counts are normalised, variable genes chosen,
    covariates regressed out, values scaled, components and neighbours found, and the graph cut into communities.

    ``cells`` carries the metrics of ``qc.cell_metrics``; ``neighbours`` counts the cell itself, as usual.
    """
    cells = cut(qc.drop_predicted_doublets(cells))
    lognorm = cut(normalize.normalize_log1p(qc.keep_cells(counts, cells)))
    flags = normalize.hvg_select(lognorm, cells, genes, max_mean=max_mean)
    chosen = cut(flags.filter("highly_variable").select("gene"))
    scores = matrix.scaled_scores(normalize.keep_genes(lognorm, chosen), cells, chosen, components)
    scores = cut(scores.withColumn("id", F.to_json(F.struct(*CELL))))
    near = cut(graph.knn_graph(scores, neighbours - 1))
    labels = graph.communities(cut(graph.fuzzy_graph(near, neighbours)), resolution)
    return scores.select(*CELL, "id").join(labels, "id", "left").select(*CELL, F.col("label").alias("leiden"))


def analyse_cells(
    counts: DataFrame,
    cells: DataFrame,
    genes: DataFrame,
    net: DataFrame,
    s_genes: DataFrame | None = None,
    g2m_genes: DataFrame | None = None,
    orthologs: DataFrame | None = None,
    expected_rate: float = 0.1,
    max_mean: float = 3.0,
    **clustering,
) -> DataFrame:
    """From counts to annotated cells: every cell of ``cells`` with ``doublet_score`` and ``predicted_doublet`` of its sample's search, and, unless
    it is a predicted doublet, with its cluster, the cluster's best cell type and ranked types by marker enrichment, and its phase.

    ``net(cell_type, genesymbol)`` are the markers. The genes of both phases are tables ``(gene)``; by default they are the built-in human lists,
    mapped by ``orthologs(human_symbol, mouse_symbol)``.
    """
    if s_genes is None or g2m_genes is None:
        if orthologs is None:
            raise ValueError("give the genes of both phases, or orthologs of the built-in human ones")
        listed = cycle.phase_gene_table(counts.sparkSession)
        s_genes, g2m_genes = (markers.ortholog_map(listed.filter(F.col("phase") == p), orthologs).select(F.col("mouse_symbol").alias("gene")) for p in ("S", "G2M"))
    scored = cut(doublets.doublet_scores(counts, cells.select(*CELL), group=["sample"], expected_rate=expected_rate, max_mean=max_mean, simulated=True))
    called = doublets.doublet_calls(scored, ["sample"]).select(*CELL, "doublet_score", "predicted_doublet")
    marked = cut(cells.join(called, CELL, "left").fillna(False, ["predicted_doublet"]))
    clusters = cut(cluster_cells(counts, marked, genes, max_mean=max_mean, **clustering))
    kept = clusters.select(*CELL)
    lognorm = cut(normalize.normalize_log1p(qc.keep_cells(counts, kept)))
    enriched = markers.replace_nonfinite(cut(markers.ora_scores(lognorm, kept, genes, net)))
    best = markers.top_celltypes(markers.rank_sources(enriched, clusters.withColumnRenamed("leiden", "group")))
    phases = cycle.cell_cycle_phase(lognorm, kept, genes, s_genes, g2m_genes)
    return marked.join(markers.annotate_cells(clusters, best), CELL, "left").join(phases, CELL, "left")
