"""Queries on vectors, graphs and doublets."""

from __future__ import annotations

from pyspark.sql import functions as F

from celltrace.operators import approximate, chain, cycle, doublets, graph, matrix, qc, sketch
from celltrace.plans.count_queries import UP_TO_GOOD
from celltrace.plans.proxies import HVG_MAX_MEAN, Tables
from celltrace.plans.registry import long, query, rounded
from celltrace.schema import CELL
from celltrace.session import cut

K = 9

NEAR = f"""
e AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
near AS (SELECT src, dst, dist, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank
         FROM (SELECT a.id AS src, b.id AS dst, list_distance(a.v, b.v) AS dist FROM e a JOIN e b ON a.id <> b.id) QUALIFY rank <= {K})"""

FUZZY = """
d AS (SELECT src, list(dist ORDER BY dist) AS d, coalesce(min(dist) FILTER (WHERE dist > 0), 0) AS rho FROM near GROUP BY src),
bis AS (
  SELECT 0 AS it, src, d, rho, 0.0::DOUBLE AS lo, NULL::DOUBLE AS hi, 1.0::DOUBLE AS mid FROM d
  UNION ALL
  SELECT it + 1, src, d, rho, CASE WHEN m > log2(10) THEN lo ELSE mid END, CASE WHEN m > log2(10) THEN mid ELSE hi END,
         CASE WHEN m > log2(10) THEN (lo + mid) / 2 WHEN hi IS NULL THEN mid * 2 ELSE (mid + hi) / 2 END
  FROM (SELECT *, list_sum([exp(-greatest(x - rho, 0) / mid) FOR x IN d]) AS m FROM bis WHERE it < 64)),
sig AS (SELECT src, rho, greatest(mid, list_avg(d) * 1e-3) AS sigma FROM bis WHERE it = 64),
dir AS (SELECT n.src, n.dst, n.dist, exp(-greatest(n.dist - rho, 0) / sigma) AS w FROM near n JOIN sig USING (src)),
edges AS (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, max(dist) AS dist,
          coalesce(max(w) FILTER (WHERE src < dst), 0) + coalesce(max(w) FILTER (WHERE src > dst), 0)
          - coalesce(max(w) FILTER (WHERE src < dst), 0) * coalesce(max(w) FILTER (WHERE src > dst), 0) AS weight
          FROM dir GROUP BY 1, 2)"""


def neighbours(t: Tables):
    return graph.knn_graph(t.vectors, K)


def weights(t: Tables):
    return cut(graph.fuzzy_graph(cut(neighbours(t)), K + 1))


@query("knn_graph", f"WITH {NEAR} SELECT src, dst, rank, round(dist, 6) + 0.0 AS dist FROM near")
def _(t: Tables):
    return neighbours(t).select("src", "dst", long("rank").alias("rank"), rounded("dist").alias("dist"))


@query("approximate_knn")
def _(t: Tables):
    """Neighbours by bucketed random projections and refinement; the tests compare with the exact search."""
    return approximate.approximate_knn(t.vectors, K)


@query(
    "approximate_knn_recall",
    f"WITH {NEAR} SELECT count(DISTINCT src) AS points, count(*) AS links, true AS recall_of_90_percent, true AS none_is_too_near FROM near",
)
def _(t: Tables):
    """The approximate neighbours beside the exact ones: nine tenths of them at least, and at no rank a smaller distance than the exact one."""
    exact = cut(neighbours(t).select("src", F.col("rank").cast("int").alias("rank"), F.col("dst").alias("true_dst"), F.col("dist").alias("true_dist")))
    found = cut(approximate.approximate_knn(t.vectors, K).withColumn("rank", F.col("rank").cast("int")))
    hits = found.join(exact.select("src", F.col("true_dst").alias("dst")), ["src", "dst"], "left_semi").agg(F.count(F.lit(1))).scalar()
    sides = found.join(exact, ["src", "rank"])
    return sides.agg(F.count_distinct("src").alias("points"), F.count(F.lit(1)).alias("links"), (F.min(F.col("dist") - F.col("true_dist")) > -1e-9).alias("none_is_too_near")).withColumn(
        "recall_of_90_percent", hits >= 0.9 * F.col("links")
    )


@query(
    "fuzzy_graph",
    f"WITH RECURSIVE {NEAR}, {FUZZY} SELECT src, dst, round(dist, 6) + 0.0 AS dist, round(weight, 6) + 0.0 AS weight FROM edges",
)
def _(t: Tables):
    return weights(t).select("src", "dst", rounded("dist").alias("dist"), rounded("weight").alias("weight"))


@query(
    "modularity",
    f"""WITH RECURSIVE {NEAR}, {FUZZY},
        w AS (SELECT sum(weight) AS w, sum(weight) FILTER (WHERE a.label = b.label) AS inside
              FROM edges JOIN e a ON a.id = src JOIN e b ON b.id = dst),
        k AS (SELECT label, sum(weight) AS k FROM (SELECT src AS id, weight FROM edges UNION ALL SELECT dst, weight FROM edges) JOIN e USING (id) GROUP BY label)
        SELECT round(any_value(inside) / any_value(w) - 0.8 * sum(k * k) / (4 * any_value(w) * any_value(w)), 6) + 0.0 AS modularity FROM k, w""",
)
def _(t: Tables):
    return graph.modularity(weights(t), t.vectors.select("id", "label")).select(rounded("modularity").alias("modularity"))


@query("communities")
def _(t: Tables):
    """Parts of the neighbour graph; the tests compare their modularity."""
    return graph.communities(weights(t))


@query("graph_layout")
def _(t: Tables):
    return graph.graph_layout(weights(t))


@query(
    "communities_settled",
    f"""WITH RECURSIVE {NEAR}, {FUZZY}
        SELECT count(DISTINCT id) AS nodes, 0::BIGINT AS gaining FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges)""",
)
def _(t: Tables):
    """Nodes in communities, and those that would still gain by a move: none."""
    edges = weights(t)
    gains = graph.move_gains(cut(graph.both_directions(edges)), cut(graph.communities(edges)), 0.8)
    return gains.agg(F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("gain") > 1e-8).alias("gaining"))


@query(
    "graph_layout_settled",
    f"""WITH RECURSIVE {NEAR}, {FUZZY}, n AS (SELECT count(DISTINCT id) AS nodes FROM (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges))
        SELECT axis, nodes, true AS eigenvector, true AS nontrivial FROM n, (VALUES ('x'), ('y')) AS a(axis)""",
)
def _(t: Tables):
    """Both coordinates solve the eigenvalue equation of the normalised graph, apart from its trivial solution."""
    edges = weights(t)
    arcs = cut(graph.both_directions(edges))
    degree = arcs.groupBy("src").agg(F.sum("weight").alias("k")).withColumnRenamed("src", "id")
    # with p = coordinate and D the degrees, the equation is W p = theta D p
    place = cut(graph.graph_layout(edges)).join(degree, "id")
    long_form = cut(place.select("id", "k", F.explode(F.array(F.struct(F.lit("x").alias("axis"), F.col("x").alias("p")), F.struct(F.lit("y").alias("axis"), F.col("y").alias("p")))).alias("c")).select("id", "k", "c.*"))
    pulled = arcs.join(long_form.select(F.col("id").alias("dst"), "axis", "p"), "dst").groupBy(F.col("src").alias("id"), "axis").agg(F.sum(F.col("weight") * F.col("p")).alias("wp"))
    sums = long_form.join(pulled, ["id", "axis"]).groupBy("axis").agg(
        F.count(F.lit(1)).alias("nodes"), F.sum(F.col("k") * F.col("p")).alias("kp"), F.sum(F.col("k") * F.col("p") * F.col("p")).alias("kpp"),
        F.sum("k").alias("k"), F.sum(F.col("p") * F.col("wp")).alias("pwp"), F.sum(F.col("wp") * F.col("wp") / F.col("k")).alias("ww"),
    )
    theta = F.col("pwp") / F.col("kpp")
    residual = F.sqrt(F.greatest(F.col("ww") / F.col("kpp") - theta * theta, F.lit(0.0)))
    return sums.select("axis", "nodes", (residual < 1e-3).alias("eigenvector"), (F.abs("kp") / F.sqrt(F.col("kpp") * F.col("k")) < 1e-6).alias("nontrivial"))


@query(
    "pca_invariants",
    """WITH x AS (SELECT unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings),
       s AS (SELECT var_samp(v) AS v FROM x GROUP BY d)
       SELECT 40::BIGINT AS components, round(sum(v), 6) + 0.0 AS total_variance, true AS scores_have_the_variance, true AS scores_are_uncorrelated FROM s""",
)
def _(t: Tables):
    """What components must fulfil: the total variance, and scores that are uncorrelated with the listed variances."""
    scores, model = matrix.pca(t.vectors, 40)
    pairs = scores.select("id", F.posexplode("v").alias("i", "a"))
    both = pairs.join(pairs.select("id", F.col("i").alias("j"), F.col("a").alias("b")), "id").groupBy("i", "j").agg(F.covar_samp("a", "b").alias("cov"))
    listed = model.select((F.col("component") - F.lit(model.agg(F.min("component")).first()[0])).alias("i"), "variance")
    checked = both.join(listed, "i").agg(
        F.max(F.when(F.col("i") == F.col("j"), F.abs(F.col("cov") - F.col("variance")))).alias("own"), F.max(F.when(F.col("i") != F.col("j"), F.abs("cov"))).alias("other")
    )
    own, other = checked.select("own").scalar(), checked.select("other").scalar()
    total = model.agg(F.count(F.lit(1)).alias("components"), F.max(F.when(F.col("ratio") > 0, F.col("variance") / F.col("ratio"))).alias("total"))
    return total.select("components", rounded("total").alias("total_variance"), (own < 1e-8).alias("scores_have_the_variance"), (other < 1e-8).alias("scores_are_uncorrelated"))


@query(
    "sketched_components",
    """WITH x AS (SELECT unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) AS d FROM embeddings), s AS (SELECT var_samp(v) AS v FROM x GROUP BY d)
       SELECT 40::BIGINT AS components, round(sum(v), 6) + 0.0 AS total_variance, true AS same_variances, true AS settled FROM s""",
)
def _(t: Tables):
    """Components by sketches beside those of the Gram matrix."""
    exact = matrix.pca_fit(t.vectors, 40).select("component", F.col("variance").alias("exact"))
    both = sketch.sketched_components(t.vectors, 40).join(exact, "component")
    return both.agg(
        F.count(F.lit(1)).alias("components"), rounded(F.max(F.col("variance") / F.col("ratio"))).alias("total_variance"),
        (F.max(F.abs(F.col("variance") - F.col("exact"))) < 1e-8).alias("same_variances"), (F.max("residual") < 1e-6).alias("settled"),
    )


@query("computed_clusters", f"WITH {UP_TO_GOOD} SELECT sample, count(*) AS n, true AS several_clusters FROM good GROUP BY sample")
def _(t: Tables):
    """Counts to clusters, then cells per cluster and sample: every good cell is in one of several clusters."""
    t.keep("filtered", "good_cells")
    clusters = cut(chain.cluster_cells(t.good_counts, t.good_cells, t.genes, max_mean=HVG_MAX_MEAN))
    grid = cut(qc.cluster_sample_counts(clusters))
    several = grid.agg(F.count_distinct("leiden") > 1).scalar()
    return grid.groupBy("sample").agg(F.sum("n").alias("n")).withColumn("several_clusters", several)


@query(
    "annotated_chain",
    f"""WITH {UP_TO_GOOD} SELECT sample, count(*) AS n_cells, true AS doublets_have_no_cluster, true AS others_are_annotated, true AS others_have_a_phase, true AS proportions_sum_to_one
        FROM good GROUP BY sample""",
)
def _(t: Tables):
    """Counts to annotated cells, with an invariant for every step, per sample."""
    t.keep("filtered", "good_cells", "good_counts")
    found = cut(chain.analyse_cells(t.good_counts, t.good_cells, t.genes, t.net, t.gene_set("SMALL"), t.gene_set("LARGE"), max_mean=HVG_MAX_MEAN))
    shares = cycle.phase_proportions(found).groupBy("leiden").agg(F.sum("fraction").alias("f"))
    whole = shares.agg(F.max(F.abs(F.col("f") - 1)) < 1e-9).scalar()
    out = F.col("predicted_doublet")
    return found.groupBy("sample").agg(
        F.count(F.lit(1)).alias("n_cells"), F.bool_and(~out | F.col("leiden").isNull()).alias("doublets_have_no_cluster"),
        F.bool_and(out | (F.col("ora_cell_type").isNotNull() & F.col("ora_top_celltypes").startswith(F.col("ora_cell_type")))).alias("others_are_annotated"),
        F.bool_and(out | (F.col("phase") == cycle.phase_of("s_score", "g2m_score"))).alias("others_have_a_phase"),
    ).withColumn("proportions_sum_to_one", whole)


@query("pca_variance")
def _(t: Tables):
    """Variance of the components; the tests compare with numpy on the same rows."""
    return matrix.pca_fit(t.vectors, 40).select("component", rounded("variance").alias("variance"), rounded("ratio").alias("ratio"))


@query("pca_scores")
def _(t: Tables):
    scores, _ = matrix.pca(t.vectors, 40)
    return scores.select("id", F.transform("v", lambda x: F.round(x, 6)).alias("scores"))


SYN = f"""
idx AS (SELECT sample, cell, row_number() OVER (PARTITION BY sample ORDER BY cell) - 1 AS i, count(*) OVER (PARTITION BY sample) AS n FROM good),
pairs AS (SELECT sample, n, unnest([2 * i, 2 * i + 1]) AS syn FROM idx),
parents AS (SELECT sample, syn, unnest([(7 * syn + 3) % n, (5 * syn + 1) % n]) AS i FROM pairs),
syn AS (SELECT p.sample, p.syn, f.gene, sum(f.x) AS x FROM parents p JOIN idx USING (sample, i) JOIN f4 f ON f.sample = idx.sample AND f.cell = idx.cell GROUP BY 1, 2, 3)"""


@query("synthetic_doublets", f"WITH {UP_TO_GOOD}, {SYN} SELECT sample, syn, gene, round(x, 6) + 0.0 AS x FROM syn")
def _(t: Tables):
    """Pairs by arithmetic on the cell's place, so that SQL can repeat them."""

    def parent(number, n, which):
        return (number * 7 + 3) % n if which == 1 else (number * 5 + 1) % n

    t.keep("filtered", "good_cells", "good_counts")
    made = doublets.synthetic_doublets(t.good_counts, t.good_cells, group=["sample"], parent=parent, order=["cell"])
    return made.withColumn("x", rounded("x"))


def scored(t: Tables, **options):
    t.keep("filtered", "good_cells", "good_counts")
    return doublets.doublet_scores(t.good_counts, t.good_cells.select(*CELL), group=["sample"], max_mean=HVG_MAX_MEAN, **options)


@query(
    "simulated_neighbour_scores",
    """WITH p AS (SELECT vec_id AS id, label % 3 AS batch, vec_id % 3 <> 0 AS is_syn, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
       t AS (SELECT batch, count(*) FILTER (WHERE NOT is_syn)::DOUBLE AS obs, count(*) FILTER (WHERE is_syn)::DOUBLE AS syn FROM p GROUP BY batch),
       z AS (SELECT batch, syn / obs AS r, greatest(round(round(sqrt(obs) * 0.5) * (1 + syn / obs)), 1)::INT AS k FROM t),
       n AS (SELECT a.batch, a.id, b.is_syn, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS rank
             FROM p a JOIN p b ON a.batch = b.batch AND a.id <> b.id),
       h AS (SELECT batch, id, k, r, count(*) FILTER (WHERE is_syn) AS hits FROM n JOIN z USING (batch) WHERE rank <= k GROUP BY ALL),
       q AS (SELECT *, (hits + 1.0::DOUBLE) / (k + 2.0::DOUBLE) AS q FROM h)
       SELECT batch, id, round((q * 0.05::DOUBLE / r) / (0.95::DOUBLE - q * (0.95::DOUBLE - 0.05::DOUBLE / r)), 6) + 0.0 AS doublet_score FROM q""",
)
def _(t: Tables):
    """The score of doublet detection on vectors of which two thirds are marked as simulated."""
    points = t.read("embeddings").select(
        F.col("vec_id").alias("id"), (F.col("label") % 3).alias("batch"), (F.col("vec_id") % 3 != 0).alias("is_syn"), F.col("embedding").cast("array<double>").alias("v")
    )
    found = doublets.simulated_neighbour_scores(points, ["batch"], 0.05)
    return found.withColumn("doublet_score", rounded("doublet_score"))


@query(
    "doublet_scores_full_rank",
    f"""WITH {UP_TO_GOOD},
        idx AS (SELECT sample, cell, row_number() OVER (ORDER BY cell, sample) - 1 AS i, count(*) OVER () AS n FROM good),
        parents AS (SELECT syn, unnest([(7 * syn + 3) % n, (5 * syn + 1) % n]) AS i FROM (SELECT n, unnest([2 * i, 2 * i + 1]) AS syn FROM idx)),
        syn AS (SELECT p.syn, f.gene, sum(f.x) AS x FROM parents p JOIN idx USING (i) JOIN f4 f ON f.sample = idx.sample AND f.cell = idx.cell GROUP BY 1, 2),
        raw AS (SELECT false AS is_syn, sample, cell, gene, x FROM f4 UNION ALL SELECT true, '', 'syn' || syn, gene, x FROM syn),
        norm AS MATERIALIZED (SELECT is_syn, sample, cell, gene, ln(1 + x * 10000.0 / sum(x) OVER (PARTITION BY is_syn, sample, cell)) AS x FROM raw),
        nn AS (SELECT count(*)::DOUBLE AS n FROM good),
        gs AS (SELECT gene, sum(exp(x) - 1) / any_value(n) AS m, sum((exp(x) - 1) * (exp(x) - 1)) AS s2, any_value(n) AS n FROM norm, nn WHERE NOT is_syn GROUP BY gene),
        ge AS (SELECT gene, ln(1 + m) AS mean, CASE WHEN (s2 - n * m * m) / (n - 1) / m > 0 THEN ln((s2 - n * m * m) / (n - 1) / m) END AS dispersion FROM gs),
        gb AS (SELECT *, greatest(1, ceil(20 * (mean - min(mean) OVER ()) / (max(mean) OVER () - min(mean) OVER ())))::BIGINT AS bin FROM ge),
        gn AS (SELECT *, avg(dispersion) OVER (PARTITION BY bin) AS a, stddev_samp(dispersion) OVER (PARTITION BY bin) AS s FROM gb),
        hv AS (SELECT gene FROM gn WHERE mean > 0.0125 AND mean < {HVG_MAX_MEAN}
               AND coalesce((dispersion - CASE WHEN s IS NULL THEN 0 ELSE a END) / CASE WHEN s IS NULL THEN a ELSE s END, 0) > 1.0),
        ms AS (SELECT gene, sum(x) / any_value(n) AS mean, (sum(x * x) - sum(x) * sum(x) / any_value(n)) / (any_value(n) - 1) AS var
               FROM norm JOIN hv USING (gene), nn WHERE NOT is_syn GROUP BY gene),
        pt AS (SELECT false AS is_syn, sample, cell FROM good UNION ALL SELECT DISTINCT true, '', 'syn' || syn FROM syn),
        -- the means cancel in a distance, so only stored values are compared
        e AS MATERIALIZED (SELECT is_syn, sample, cell, gene, x / CASE WHEN var > 1e-12 THEN sqrt(var) ELSE 1 END AS x FROM norm JOIN ms USING (gene)),
        v AS MATERIALIZED (SELECT is_syn, sample, cell, coalesce(sum(x * x), 0) AS q FROM pt LEFT JOIN e USING (is_syn, sample, cell) GROUP BY 1, 2, 3),
        dot AS MATERIALIZED (SELECT a.sample AS s1, a.cell AS c1, b.is_syn, b.sample, b.cell, sum(a.x * b.x) AS ab FROM e a JOIN e b USING (gene) WHERE NOT a.is_syn GROUP BY ALL),
        z AS (SELECT count(*) FILTER (WHERE is_syn)::DOUBLE / count(*) FILTER (WHERE NOT is_syn) AS r,
                     greatest(round(round(sqrt(count(*) FILTER (WHERE NOT is_syn)) * 0.5) * (1 + count(*) FILTER (WHERE is_syn)::DOUBLE / count(*) FILTER (WHERE NOT is_syn))), 1)::INT AS k FROM v),
        near AS (SELECT a.sample, a.cell, b.is_syn, row_number() OVER (PARTITION BY a.sample, a.cell ORDER BY a.q + b.q - 2 * coalesce(ab, 0), b.is_syn, b.sample, b.cell) AS rank
                 FROM v a JOIN v b ON b.is_syn OR a.sample <> b.sample OR a.cell <> b.cell
                 LEFT JOIN dot ON s1 = a.sample AND c1 = a.cell AND dot.is_syn = b.is_syn AND dot.sample = b.sample AND dot.cell = b.cell WHERE NOT a.is_syn),
        q AS (SELECT sample, cell, (count(*) FILTER (WHERE is_syn) + 1.0::DOUBLE) / (any_value(k) + 2.0::DOUBLE) AS q, any_value(r) AS r FROM near, z WHERE rank <= k GROUP BY 1, 2)
        SELECT sample, cell, round((q * 0.05::DOUBLE / r) / (0.95::DOUBLE - q * (0.95::DOUBLE - 0.05::DOUBLE / r)), 6) + 0.0 AS doublet_score FROM q""",
)
def _(t: Tables):
    """Doublet detection from counts to scores on all cells as one batch. With fewer variable genes than cells and all components, scores
    are a rotation of the scaled genes, so SQL can compare the genes themselves."""
    t.keep("filtered", "good_cells", "good_counts")
    parent = lambda number, n, which: (number * 7 + 3) % n if which == 1 else (number * 5 + 1) % n
    found = doublets.doublet_scores(
        t.good_counts, t.good_cells.select(*CELL), n_components=4096, parent=parent, order=["cell", "sample"], max_mean=HVG_MAX_MEAN, min_disp=1.0
    )
    return found.select(*CELL, rounded("doublet_score").alias("doublet_score"))


@query("doublet_scores")
def _(t: Tables):
    return scored(t)


@query("doublet_calls")
def _(t: Tables):
    return doublets.doublet_calls(cut(scored(t, simulated=True)), ["sample"])
