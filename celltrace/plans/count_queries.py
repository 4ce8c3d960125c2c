"""Queries on count matrices: filters, metrics, normalisation, variable genes, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from celltrace.operators import matrix, normalize, qc, reports
from celltrace.plans.proxies import HVG_MAX_MEAN, MARKERS, QC_LIMITS, Tables
from celltrace.plans.registry import long, query, quick_rounded, rounded
from celltrace.schema import CELL
from celltrace.session import cut, ensure_checkpoint_dir, remember
from celltrace.sources import annotated

COUNTS = """
genes_of AS (SELECT p_partkey, p_brand, p_type, CASE WHEN p_name LIKE 'red %' THEN 'mt-' ELSE 'g' END || p_partkey AS gene FROM part),
counts AS MATERIALIZED (
  SELECT CAST(c_nationkey AS VARCHAR) AS sample, CAST(o_custkey AS VARCHAR) AS cell, gene, sum(l_quantity) AS x
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN genes_of ON l_partkey = p_partkey
  GROUP BY 1, 2, 3)"""
F1 = f"f1 AS (SELECT * FROM counts WHERE cell IN (SELECT cell FROM counts GROUP BY cell HAVING count(*) >= {QC_LIMITS['min_genes']}))"
F2 = f"f2 AS (SELECT * FROM f1 WHERE cell IN (SELECT cell FROM f1 GROUP BY cell HAVING sum(x) >= {QC_LIMITS['min_counts']}))"
F3 = f"f3 AS MATERIALIZED (SELECT * FROM f2 WHERE gene IN (SELECT gene FROM f2 GROUP BY gene HAVING count(*) >= {QC_LIMITS['min_cells']}))"
METRICS = """
metrics AS (
  SELECT sample, cell, count(*) AS n_genes_by_counts, sum(x) AS total_counts,
         coalesce(sum(x) FILTER (WHERE gene LIKE 'mt-%'), 0) AS total_counts_mt,
         100.0 * coalesce(sum(x) FILTER (WHERE gene LIKE 'mt-%'), 0) / sum(x) AS pct_counts_mt
  FROM f3 GROUP BY sample, cell)"""
GOOD = f"""
good AS (SELECT * FROM metrics WHERE n_genes_by_counts < {QC_LIMITS['max_genes']} AND pct_counts_mt < {QC_LIMITS['max_pct_mt']}),
f4 AS MATERIALIZED (SELECT f3.* FROM f3 JOIN good USING (sample, cell))"""
LOGNORM = "lognorm AS MATERIALIZED (SELECT sample, cell, gene, ln(1 + x * 10000.0 / sum(x) OVER (PARTITION BY sample, cell)) AS x FROM f4)"
UP_TO_F3 = ",".join([COUNTS, F1, F2, F3])
UP_TO_METRICS = UP_TO_F3 + "," + METRICS
UP_TO_GOOD = UP_TO_METRICS + "," + GOOD
UP_TO_LOGNORM = UP_TO_GOOD + "," + LOGNORM
HVG = f"""
nn AS (SELECT count(*)::DOUBLE AS n FROM good),
gs AS (SELECT g.gene, coalesce(sum(exp(l.x) - 1), 0) / any_value(n) AS m, coalesce(sum((exp(l.x) - 1) * (exp(l.x) - 1)), 0) AS s2, any_value(n) AS n
       FROM (SELECT DISTINCT gene FROM f3) g LEFT JOIN lognorm l USING (gene), nn GROUP BY g.gene),
gd AS (SELECT gene, CASE WHEN m = 0 THEN 1e-12 ELSE m END AS m, (s2 - n * m * m) / (n - 1) AS v FROM gs),
ge AS (SELECT gene, ln(1 + m) AS mean, CASE WHEN v / m > 0 THEN ln(v / m) END AS dispersion FROM gd),
gb AS (SELECT *, greatest(1, ceil(20 * (mean - min(mean) OVER ()) / (max(mean) OVER () - min(mean) OVER ())))::BIGINT AS bin FROM ge),
gn AS (SELECT *, avg(dispersion) OVER (PARTITION BY bin) AS a, stddev_samp(dispersion) OVER (PARTITION BY bin) AS s FROM gb),
hvg AS (SELECT gene, mean, dispersion, bin,
               coalesce((dispersion - CASE WHEN s IS NULL THEN 0 ELSE a END) / CASE WHEN s IS NULL THEN a ELSE s END, 0) AS dispersion_norm FROM gn),
flags AS (SELECT *, mean > 0.0125 AND mean < {HVG_MAX_MEAN} AND dispersion_norm > 0.5 AS highly_variable FROM hvg)"""
UP_TO_HVG = UP_TO_LOGNORM + "," + HVG


@query("merge_samples", f"WITH {COUNTS} SELECT * FROM counts")
def _(t: Tables):
    """All samples, by the hash of their name in three tables, then merged."""
    return qc.merge_samples([t.counts.filter(F.pmod(F.xxhash64("sample"), F.lit(3)) == k) for k in range(3)])


@query(
    "merge_gene_metadata",
    """WITH g AS (SELECT p_name AS gene, p_brand FROM part)
       SELECT gene, CASE WHEN min(p_brand) = max(p_brand) THEN min(p_brand) END AS p_brand FROM g GROUP BY gene""",
)
def _(t: Tables):
    """All parts, by the hash of their key in three tables, merged by gene."""
    parts = [t.read("part").filter(F.pmod(F.xxhash64("p_partkey"), F.lit(3)) == k).select(F.col("p_name").alias("gene"), "p_brand") for k in range(3)]
    return qc.merge_gene_metadata(parts, "p_brand")


@query(
    "unique_names",
    """SELECT p_partkey AS idx, p_name AS name,
              p_name || CASE WHEN r = 1 THEN '' ELSE '-' || (r - 1) END AS unique_name
       FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS r FROM part)""",
)
def _(t: Tables):
    return qc.unique_names(t.read("part").select(F.col("p_partkey").alias("idx"), F.col("p_name").alias("name")))


@query("filter_cells_genes", f"WITH {COUNTS}, {F1} SELECT * FROM f1")
def _(t: Tables):
    return qc.filter_cells(t.counts, QC_LIMITS["min_genes"])


@query("filter_cells_counts", f"WITH {COUNTS}, {F1}, {F2} SELECT * FROM f2")
def _(t: Tables):
    return qc.filter_cells(t.counts, QC_LIMITS["min_genes"], QC_LIMITS["min_counts"])


@query("filter_genes", f"WITH {UP_TO_F3} SELECT * FROM f3")
def _(t: Tables):
    return t.filtered


METRIC_COLUMNS = """sample, cell, n_genes_by_counts, round(total_counts, 6) + 0.0 AS total_counts,
    round(total_counts_mt, 6) + 0.0 AS total_counts_mt, round(pct_counts_mt, 6) + 0.0 AS pct_counts_mt"""


def metric_columns(df):
    return df.select(*CELL, "n_genes_by_counts", *[rounded(c).alias(c) for c in ("total_counts", "total_counts_mt", "pct_counts_mt")])


@query("qc_cell_metrics", f"WITH {UP_TO_METRICS} SELECT {METRIC_COLUMNS} FROM metrics")
def _(t: Tables):
    return metric_columns(t.metrics)


@query(
    "qc_gene_metrics",
    f"""WITH {UP_TO_METRICS}, n AS (SELECT count(*) AS n FROM (SELECT DISTINCT sample, cell FROM f2))
        SELECT gene, count(*) AS n_cells_by_counts, round(sum(x), 6) + 0.0 AS total_counts, round(sum(x) / any_value(n), 6) + 0.0 AS mean_counts,
               round(100.0 * (1 - count(*) / any_value(n)), 6) + 0.0 AS pct_dropout_by_counts FROM f3, n GROUP BY gene""",
)
def _(t: Tables):
    """Shares are of all cells that passed the cell floors, also of those that have lost all their genes."""
    t.keep("passed")
    m = qc.gene_metrics(t.filtered, t.passed.select(*CELL).distinct())
    return m.select("gene", "n_cells_by_counts", *[rounded(c).alias(c) for c in ("total_counts", "mean_counts", "pct_dropout_by_counts")])


@query("qc_hard_filter", f"WITH {UP_TO_GOOD} SELECT {METRIC_COLUMNS} FROM good")
def _(t: Tables):
    return metric_columns(t.good_cells)


@query("qc_scatter", f"WITH {UP_TO_METRICS} SELECT sample, cell, n_genes_by_counts, round(total_counts, 6) + 0.0 AS total_counts, round(pct_counts_mt, 6) + 0.0 AS pct_counts_mt FROM metrics")
def _(t: Tables):
    m = reports.qc_scatter(t.metrics)
    return m.select(*CELL, "n_genes_by_counts", rounded("total_counts").alias("total_counts"), rounded("pct_counts_mt").alias("pct_counts_mt"))


@query("normalize_log1p", f"WITH {UP_TO_LOGNORM} SELECT sample, cell, gene, round(x, 6) + 0.0 AS x FROM lognorm")
def _(t: Tables):
    return t.lognorm.withColumn("x", rounded("x"))


@query(
    "top_expressed_genes",
    f"""WITH {UP_TO_GOOD}, s AS (SELECT sample, cell, gene, 100.0 * x / sum(x) OVER (PARTITION BY sample, cell) AS pct FROM f4),
        n AS (SELECT count(*) AS n FROM good),
        top AS (SELECT gene, sum(pct) / any_value(n) AS mean_pct, max(pct) AS max_pct FROM s, n GROUP BY gene ORDER BY mean_pct DESC, gene LIMIT 20),
        grid AS (SELECT t.gene, coalesce(s.pct, 0) AS pct FROM top t CROSS JOIN good c LEFT JOIN s ON s.gene = t.gene AND s.sample = c.sample AND s.cell = c.cell),
        q AS (SELECT gene, count(*) AS n, quantile_cont(pct, 0.25) AS q1, quantile_cont(pct, 0.5) AS median, quantile_cont(pct, 0.75) AS q3 FROM grid GROUP BY gene)
        SELECT gene, n, round(mean_pct, 6) + 0.0 AS mean_pct, round(max_pct, 6) + 0.0 AS max_pct, round(q1, 6) + 0.0 AS q1, round(median, 6) + 0.0 AS median, round(q3, 6) + 0.0 AS q3
        FROM top JOIN q USING (gene)""",
)
def _(t: Tables):
    t.keep("filtered", "good_cells", "good_counts")
    top = qc.top_expressed_genes(t.good_counts, t.good_cells)
    return top.select("gene", "n", *[rounded(c).alias(c) for c in ("mean_pct", "max_pct", "q1", "median", "q3")])


@query(
    "hvg_select",
    f"""WITH {UP_TO_HVG} SELECT gene, round(mean, 6) + 0.0 AS mean, round(dispersion, 6) + 0.0 AS dispersion, bin,
        round(dispersion_norm, 6) + 0.0 AS dispersion_norm, highly_variable FROM flags""",
)
def _(t: Tables):
    t.keep("filtered", "good_cells")
    h = normalize.hvg_select(t.lognorm, t.good_cells, t.genes, max_mean=HVG_MAX_MEAN)
    return h.select("gene", rounded("mean").alias("mean"), rounded("dispersion").alias("dispersion"), "bin",
                    rounded("dispersion_norm").alias("dispersion_norm"), "highly_variable")


def variable_part(t: Tables):
    """Normalised values, covariates and the chosen genes, each written once: all are used several times."""
    t.keep("filtered", "good_cells", "lognorm")
    flags = normalize.hvg_select(t.lognorm, t.good_cells, t.genes, max_mean=HVG_MAX_MEAN)
    chosen = cut(flags.filter("highly_variable").select("gene"))
    return normalize.keep_genes(t.lognorm, chosen), t.good_cells, chosen


RESIDUALS = """
y AS (SELECT h.gene, c.sample, c.cell, c.total_counts AS a, c.pct_counts_mt AS b, coalesce(l.x, 0) AS x
      FROM (SELECT gene FROM flags WHERE highly_variable) h CROSS JOIN good c
      LEFT JOIN lognorm l ON l.gene = h.gene AND l.sample = c.sample AND l.cell = c.cell),
fit AS (SELECT gene, avg(x) AS my, avg(a) AS ma, avg(b) AS mb, covar_samp(x, a) AS ya, covar_samp(x, b) AS yb,
               var_samp(a) AS aa, var_samp(b) AS bb, covar_samp(a, b) AS ab FROM y GROUP BY gene),
beta AS (SELECT gene, my, ma, mb, (ya * bb - yb * ab) / (aa * bb - ab * ab) AS b1, (yb * aa - ya * ab) / (aa * bb - ab * ab) AS b2 FROM fit),
res AS (SELECT y.sample, y.cell, y.gene, y.x - (my + b1 * (a - ma) + b2 * (b - mb)) AS residual FROM y JOIN beta USING (gene))"""


@query("regress_out", f"WITH {UP_TO_HVG}, {RESIDUALS} SELECT sample, cell, gene, floor(residual * 10000.0::DOUBLE + 0.5) / 10000.0::DOUBLE AS residual FROM res")
def _(t: Tables):
    vectors, axis = matrix.regress_out(*variable_part(t))
    return matrix.vectors_to_long(vectors, axis, "residual").withColumn("residual", quick_rounded("residual"))


@query(
    "scale_genes",
    f"""WITH {UP_TO_HVG}, {RESIDUALS},
        sd AS (SELECT gene, avg(residual) AS m, stddev_samp(residual) AS s FROM res GROUP BY gene)
        SELECT sample, cell, gene, floor(greatest(-10, least(10, (residual - m) / CASE WHEN s = 0 THEN 1 ELSE s END)) * 10000.0::DOUBLE + 0.5) / 10000.0::DOUBLE AS z FROM res JOIN sd USING (gene)""",
)
def _(t: Tables):
    vectors, axis = matrix.regress_out(*variable_part(t), scaled=True)
    return matrix.vectors_to_long(vectors, axis, "z").withColumn("z", quick_rounded("z"))


CLUSTERS = """
clusters AS (SELECT CAST(c_nationkey AS VARCHAR) AS sample, CAST(c_custkey AS VARCHAR) AS cell,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '0' WHEN 'FURNITURE' THEN '1' WHEN 'HOUSEHOLD' THEN '22' WHEN 'BUILDING' THEN '14' WHEN 'MACHINERY' THEN '7' END AS leiden
  FROM customer)"""
LABELS = """
labelled AS (SELECT *, CASE WHEN leiden IN ('0', '1', '13', '22') THEN 'Endothelial cells' WHEN leiden = '14' THEN 'Mesenchymal type' END AS group_labels FROM clusters)"""


@query(
    "cluster_sample_counts",
    f"""WITH {CLUSTERS}, n AS (SELECT leiden, sample, count(*) AS n FROM clusters GROUP BY 1, 2)
        SELECT l.leiden, s.sample, coalesce(n.n, 0) AS n, total
        FROM (SELECT leiden, count(*) AS total FROM clusters GROUP BY 1) l CROSS JOIN (SELECT DISTINCT sample FROM clusters) s
        LEFT JOIN n ON n.leiden = l.leiden AND n.sample = s.sample""",
)
def _(t: Tables):
    return qc.cluster_sample_counts(t.clusters)


@query("group_labels", f"WITH {CLUSTERS}, {LABELS} SELECT * FROM labelled")
def _(t: Tables):
    return reports.group_labels(t.clusters)


@query(
    "annotated_columns",
    f"""WITH {UP_TO_METRICS}, {CLUSTERS}, {LABELS}
        SELECT m.sample, m.cell, n_genes_by_counts, round(total_counts, 6) + 0.0 AS total_counts, CASE WHEN leiden <> '7' THEN 'c' || leiden END AS leiden, group_labels
        FROM metrics m LEFT JOIN labelled l ON l.sample = m.sample AND l.cell = m.cell""",
)
def _(t: Tables):
    """Cells written with their metrics; a step adds clusters and labels, a second one replaces the clusters."""
    folder = remember(f"{ensure_checkpoint_dir(t.spark)}/cells-{uuid.uuid4().hex}")
    annotated.create_cells(t.metrics, folder)
    annotated.append_columns(reports.group_labels(t.clusters), folder, "clusters")
    again = t.clusters.filter("leiden <> '7'").withColumn("leiden", F.concat(F.lit("c"), "leiden"))
    annotated.append_columns(again, folder, "clusters")
    found = annotated.read_cells(t.spark, folder, ["n_genes_by_counts", "total_counts", "leiden", "group_labels"])
    return found.withColumns({"n_genes_by_counts": long("n_genes_by_counts"), "total_counts": rounded("total_counts")})


BOX = "round(mean, 6) + 0.0 AS mean, round(min, 6) + 0.0 AS min, round(q1, 6) + 0.0 AS q1, round(median, 6) + 0.0 AS median, round(q3, 6) + 0.0 AS q3, round(max, 6) + 0.0 AS max"


def box(df, *keys):
    return df.select(*keys, "n", *[rounded(c).alias(c) for c in ("mean", "min", "q1", "median", "q3", "max")])


def stats_sql(value: str) -> str:
    return f"""count(*) AS n, avg({value}) AS mean, min({value}) AS min, quantile_cont({value}, 0.25) AS q1,
               quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3, max({value}) AS max"""


@query(
    "qc_violin_stats",
    f"""WITH {UP_TO_METRICS}, v AS (SELECT 'n_genes_by_counts' AS metric, n_genes_by_counts::DOUBLE AS value FROM metrics
          UNION ALL SELECT 'total_counts', total_counts FROM metrics UNION ALL SELECT 'pct_counts_mt', pct_counts_mt FROM metrics),
        s AS (SELECT metric, {stats_sql('value')} FROM v GROUP BY metric)
        SELECT metric, n, {BOX} FROM s""",
)
def _(t: Tables):
    return box(reports.qc_violin_stats(t.keep("metrics").metrics), "metric")


WANTED = "(SELECT DISTINCT gene FROM f3 WHERE gene IN ({}))".format(", ".join(f"'{g}'" for g in MARKERS))


def present_markers(t: Tables, genes) -> list[str]:
    """The requested markers that the matrix has (at most as many as were asked for)."""
    return sorted(r[0] for r in reports.markers_present(t.marker_request, genes).collect())


@query(
    "marker_violin_stats",
    f"""WITH {UP_TO_LOGNORM}, {CLUSTERS}, {LABELS},
        v AS (SELECT c.group_labels, g.gene, coalesce(l.x, 0) AS x FROM (SELECT sample, cell, group_labels FROM labelled JOIN good USING (sample, cell) WHERE group_labels IS NOT NULL) c
              CROSS JOIN {WANTED} g LEFT JOIN lognorm l ON l.sample = c.sample AND l.cell = c.cell AND l.gene = g.gene),
        s AS (SELECT group_labels, gene, {stats_sql('x')} FROM v GROUP BY 1, 2)
        SELECT group_labels, gene, n, {BOX} FROM s""",
)
def _(t: Tables):
    t.keep("filtered", "good_cells")
    cells = reports.group_labels(t.clusters).join(t.good_cells.select(*CELL), CELL, "left_semi")
    return box(reports.marker_violin_stats(t.lognorm, cells, present_markers(t, t.genes)), "group_labels", "gene")


@query(
    "marker_expression",
    f"""WITH {UP_TO_LOGNORM}, {CLUSTERS}
        SELECT c.sample, c.cell, c.leiden, g.gene, round(coalesce(l.x, 0), 6) + 0.0 AS x
        FROM (SELECT clusters.* FROM clusters JOIN good USING (sample, cell)) c CROSS JOIN {WANTED} g
        LEFT JOIN lognorm l ON l.sample = c.sample AND l.cell = c.cell AND l.gene = g.gene""",
)
def _(t: Tables):
    t.keep("filtered", "good_cells")
    cells = t.clusters.join(t.good_cells.select(*CELL), CELL, "left_semi")
    return reports.marker_expression(t.lognorm, cells, present_markers(t, t.genes)).withColumn("x", rounded("x"))


@query("markers_present", f"WITH {UP_TO_F3} SELECT gene FROM {WANTED} w")
def _(t: Tables):
    return reports.markers_present(t.marker_request, t.genes)


@query(
    "markers_missing",
    f"WITH {UP_TO_F3} SELECT * FROM (VALUES {', '.join(f'(chr(103) || {g[1:]})' for g in MARKERS)}) v(gene) WHERE gene NOT IN (SELECT gene FROM f3)",
)
def _(t: Tables):
    return reports.markers_missing(t.marker_request, t.genes)


@query(
    "score_histogram",
    """WITH e AS (SELECT min(value) AS lo, max(value) AS hi, avg(CASE WHEN value > 100 THEN 1.0 ELSE 0.0 END) AS f FROM events),
       b AS (SELECT CAST(least(floor((value - lo) * 50 / (hi - lo)), 49) AS BIGINT) AS bin, count(*) AS n FROM events, e GROUP BY 1)
       SELECT CAST(r.range AS BIGINT) AS bin, round(lo + r.range * (hi - lo) / 50, 6) + 0.0 AS left_edge, coalesce(n, 0) AS n, round(f, 6) + 0.0 AS fraction_above_line
       FROM range(50) r CROSS JOIN e LEFT JOIN b ON b.bin = r.range""",
)
def _(t: Tables):
    h = reports.score_histogram(t.read("events"), "value", 50, 100.0)
    return h.select(long("bin").alias("bin"), rounded("left_edge").alias("left_edge"), "n", rounded("fraction_above_line").alias("fraction_above_line"))


@query(
    "score_kde",
    """WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(*)::DOUBLE AS n, stddev_samp(value) * pow(count(*), -0.2) AS h FROM events)
       SELECT CAST(r.range AS BIGINT) AS point, round(lo + r.range * (hi - lo) / 199, 6) + 0.0 AS at,
              round(sum(exp(-0.5 * pow((lo + r.range * (hi - lo) / 199 - value) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) + 0.0 AS density
       FROM events CROSS JOIN s CROSS JOIN range(200) r GROUP BY r.range, lo, hi""",
)
def _(t: Tables):
    k = reports.score_kde(t.read("events"), "value")
    return k.select(long("point").alias("point"), rounded("at").alias("at"), rounded("density", 9).alias("density"))
