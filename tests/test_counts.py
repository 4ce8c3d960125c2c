import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from celltrace.operators import matrix, normalize, ordering, qc, reports
from celltrace.operators.ordering import bounded_values, exact_quantiles, rank_in_group
from celltrace.session import cut
from tests.conftest import rows

COUNTS = [("c1", "g1", 4.0), ("c1", "mt-a", 1.0), ("c2", "g1", 2.0), ("c3", "g2", 5.0), ("c3", "mt-a", 5.0)]


@pytest.fixture
def counts(spark):
    return spark.createDataFrame([("s", *r) for r in COUNTS], "sample string, cell string, gene string, x double")


@pytest.fixture
def cells(counts):
    return counts.select("sample", "cell").distinct()


@pytest.fixture(scope="module")
def dense():
    rng = np.random.default_rng(3)
    x = rng.poisson(rng.uniform(0.1, 2.5, size=30), size=(60, 30)).astype(float)
    x[0, :] = 0
    return x


def to_long(spark, x):
    data = [("s", f"c{i:03d}", f"g{j:03d}", float(x[i, j])) for i, j in zip(*np.nonzero(x))]
    return spark.createDataFrame(data, "sample string, cell string, gene string, x double")


def all_cells(spark, x):
    return spark.createDataFrame([("s", f"c{i:03d}") for i in range(len(x))], "sample string, cell string")


def test_metrics(counts, cells):
    got = rows(qc.cell_metrics(counts), "cell", "n_genes_by_counts", "total_counts", "total_counts_mt", "pct_counts_mt")
    assert got == [("c1", 2, 5.0, 1.0, 20.0), ("c2", 1, 2.0, 0.0, 0.0), ("c3", 2, 10.0, 5.0, 50.0)]
    g1 = qc.gene_metrics(counts, cells).filter("gene = 'g1'").first()
    assert (g1.n_cells_by_counts, g1.mean_counts, g1.total_counts) == (2, 2.0, 6.0)
    assert g1.pct_dropout_by_counts == pytest.approx(100 / 3)


def test_filters_in_order(counts):
    kept = qc.filter_genes(qc.filter_cells(counts, 2, 6), 1)
    assert rows(kept, "cell", "gene") == [("c3", "g2"), ("c3", "mt-a")]
    assert rows(qc.qc_hard_filter(qc.cell_metrics(counts), 2, 101.0), "cell") == [("c2",)]


def test_normalize(counts):
    got = {(c, g): x for c, g, x in rows(normalize.normalize_log1p(counts, 10.0), "cell", "gene", "x")}
    assert got["c1", "g1"] == pytest.approx(math.log(9)) and got["c1", "mt-a"] == pytest.approx(math.log(3))


def test_unique_names(spark):
    df = spark.createDataFrame(list(enumerate("abaa")), "idx long, name string")
    assert [r[0] for r in qc.unique_names(df).orderBy("idx").select("unique_name").collect()] == ["a", "b", "a-1", "a-2"]
    taken = ["a", "a-1", "a", "a", "a-3", "b", "a"]
    df = spark.createDataFrame(list(enumerate(taken)), "idx long, name string")
    got = [r[0] for r in qc.unique_names(df).orderBy("idx").select("unique_name").collect()]
    assert got == ["a", "a-1", "a-2", "a-4", "a-3", "b", "a-5"]


def test_merge_keeps_equal_cell_names_apart(spark, counts):
    other = counts.withColumn("sample", F.lit("t"))
    assert qc.merge_samples([counts, other]).select("sample", "cell").distinct().count() == 6
    a = spark.createDataFrame([("g", "x"), ("h", "y")], "gene string, id string")
    b = spark.createDataFrame([("g", "z"), ("h", "y")], "gene string, id string")
    assert rows(qc.merge_gene_metadata([a, b], "id")) == [("g", None), ("h", "y")]


def test_quantiles_with_zeros(spark, dense):
    totals = spark.createDataFrame([(f"g{j:03d}", 60) for j in range(30)], "gene string, n long")
    signed = dense - np.where(dense > 1, 3, 0)
    got = exact_quantiles(to_long(spark, signed), ["gene"], "x", {"q1": 0.25, "m": 0.5, "q3": 0.75}, totals)
    for r in got.collect():
        assert [r.q1, r.m, r.q3] == pytest.approx(list(np.percentile(signed[:, int(r.gene[1:])], [25, 50, 75])))


def test_rank_in_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    ranked = rank_in_group(df, ["k"], ["id"], "r")
    assert ranked.filter("k = 0").agg(F.max("r"), F.count_distinct("r")).first() == (1667, 1667)
    assert ranked.filter("k <> 0 AND r <> 1").count() == 0


def test_report_axis_is_bounded(spark):
    with pytest.raises(Exception, match="more than 10"):
        spark.range(1).select(bounded_values(spark.range(20), "id", 10)).collect()


def test_variable_genes(spark, dense):
    log = np.log1p(dense)
    flags = normalize.hvg_select(to_long(spark, log), all_cells(spark, dense)).collect()
    mean, var = dense.mean(axis=0), dense.var(axis=0, ddof=1)
    disp, lm = np.log(var / mean), np.log1p(mean)
    bins = np.maximum(1, np.ceil(20 * (lm - lm.min()) / (lm.max() - lm.min())))
    for r in flags:
        j = int(r.gene[1:])
        same = disp[bins == bins[j]]
        norm = 1.0 if len(same) == 1 else (disp[j] - same.mean()) / same.std(ddof=1)
        assert (r.mean, r.dispersion, r.bin) == pytest.approx((lm[j], disp[j], bins[j]))
        assert r.dispersion_norm == pytest.approx(norm)


def test_regression_residuals_and_scale(spark, dense):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=60), rng.normal(size=60)
    cov = spark.createDataFrame([("s", f"c{i:03d}", float(a[i]), float(b[i])) for i in range(60)], "sample string, cell string, a double, b double")
    long = to_long(spark, dense)
    vectors, axis = matrix.regress_out(long, cov, long.select("gene").distinct(), ("a", "b"))
    got = np.array([r.v for r in vectors.orderBy("cell").collect()])
    design = np.column_stack([np.ones(60), a, b])
    columns = [int(g[1:]) for g in axis]
    want = dense[:, columns] - design @ np.linalg.lstsq(design, dense[:, columns], rcond=None)[0]
    assert np.allclose(got, want) and np.allclose(design.T @ got, 0, atol=1e-9)
    z = np.array([r.v for r in matrix.scale_vectors(vectors, 1.5).orderBy("cell").collect()])
    assert np.allclose(z, np.clip((want - want.mean(axis=0)) / want.std(axis=0, ddof=1), -1.5, 1.5))


def test_scaled_residuals_in_one_pass(spark, dense):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=60), rng.normal(size=60)
    x = dense.copy()
    x[:, 1], x[:, 2] = 2 + 3 * a - b, 4.0  # explained by the covariates, and constant
    cov = spark.createDataFrame([("s", f"c{i:03d}", float(a[i]), float(b[i])) for i in range(60)], "sample string, cell string, a double, b double")
    long = to_long(spark, x)
    genes = long.select("gene").distinct()
    vectors, axis = matrix.regress_out(long, cov, genes, ("a", "b"))
    want = np.array([r.v for r in matrix.scale_vectors(vectors, 1.5).orderBy("cell").collect()])
    scaled, again = matrix.regress_out(long, cov, genes, ("a", "b"), scaled=True, max_value=1.5)
    got = np.array([r.v for r in scaled.orderBy("cell").collect()])
    plain = [i for i, g in enumerate(axis) if int(g[1:]) not in (1, 2)]
    assert again == axis and np.allclose(got[:, plain], want[:, plain])
    rest = [i for i in range(len(axis)) if i not in plain]
    assert np.allclose(got[:, rest], 0, atol=1e-9)


def test_twenty_thousand_genes(spark):
    rng = np.random.default_rng(6)
    x = rng.poisson(0.02, (12, 20_000)).astype(float)
    a, b = rng.normal(size=12), rng.normal(size=12)
    cov = spark.createDataFrame([("s", f"c{i:03d}", float(a[i]), float(b[i])) for i in range(12)], "sample string, cell string, a double, b double")
    genes = spark.range(20_000).select(F.format_string("g%03d", "id").alias("gene"))
    scaled, axis = matrix.regress_out(to_long(spark, x), cov, genes, ("a", "b"), scaled=True)
    got = np.array([r.v for r in scaled.orderBy("cell").collect()])
    design = np.column_stack([np.ones(12), a, b])
    x = x[:, [int(g[1:]) for g in axis]]
    left = x - design @ np.linalg.lstsq(design, x, rcond=None)[0]
    std = left.std(axis=0, ddof=1)
    assert got.shape == (12, 20_000) and np.allclose(got, np.clip(left / np.where(std > 1e-9, std, 1), -10, 10), atol=1e-6)


@pytest.mark.parametrize("shape", [(60, 12), (10, 25)])
def test_components(spark, shape):
    rng = np.random.default_rng(7)
    x = rng.normal(size=shape) * np.linspace(3, 1, shape[1]) + 5
    data = [("s", f"c{i:03d}", "ab"[i % 2], [float(t) for t in x[i]]) for i in range(len(x))]
    df = spark.createDataFrame(data, "sample string, cell string, g string, v array<double>")
    scores, model = matrix.pca(df, 4)
    centred = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    assert [r.variance for r in model.orderBy("component").collect()] == pytest.approx(list(s[:4] ** 2 / (len(x) - 1)))
    got = np.array([r.v for r in scores.orderBy("cell").collect()])
    assert np.allclose(np.abs(got), np.abs(centred @ vt[:4].T))
    grouped = matrix.pca_fit(df, 2, ["g"]).filter("g = 'b'").orderBy("component").collect()
    half = x[1::2] - x[1::2].mean(axis=0)
    assert [r.variance for r in grouped] == pytest.approx(list(np.linalg.svd(half)[1][:2] ** 2 / (len(half) - 1)))


def test_violin_counts_zeros(spark, counts, cells):
    obs = cells.withColumn("group_labels", F.lit("A"))
    got = {r.gene: r for r in reports.marker_violin_stats(counts, obs, ["g1", "zz"]).collect()}
    assert (got["g1"].n, got["g1"].mean, got["g1"].min, got["g1"].median, got["g1"].max) == (3, 2.0, 0.0, 2.0, 4.0)
    assert (got["zz"].n, got["zz"].max) == (3, 0.0)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 10)], "v double")
    got = rows(reports.score_histogram(df, "v", 5, 1.5), "bin", "n", "fraction_above_line")
    assert got == [(0, 2, 0.5), (1, 1, 0.5), (2, 0, 0.5), (3, 0, 0.5), (4, 1, 0.5)]


def test_density_integrates_to_one_half_tails(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(x),) for x in rng.normal(size=400)], "v double")
    k = reports.score_kde(df, "v").orderBy("point").toPandas()
    assert 0.95 < np.trapezoid(k.density, k["at"]) < 1.0


def test_cluster_counts(spark):
    obs = spark.createDataFrame([("0", "a"), ("0", "a"), ("1", "b")], "leiden string, sample string")
    assert rows(qc.cluster_sample_counts(obs)) == [("0", "a", 2, 2), ("0", "b", 0, 2), ("1", "a", 0, 1), ("1", "b", 1, 1)]
    assert rows(qc.cluster_sample_wide(obs, ["a", "b"])) == [("0", 2, 0, 2), ("1", 0, 1, 1)]


def test_marker_lists(spark):
    req = spark.createDataFrame([("a",), ("b",)], "gene string")
    have = spark.createDataFrame([("a",)], "gene string")
    assert rows(reports.markers_present(req, have)) == [("a",)] and rows(reports.markers_missing(req, have)) == [("b",)]


@pytest.mark.parametrize("n", [8, 30])
def test_number_of_components_does_not_depend_on_the_way(spark, n):
    """Few cells and many cells of rank one give the same rows, the empty components with variance zero."""
    rng = np.random.default_rng(n)
    x = np.outer(rng.standard_normal(n), rng.standard_normal(12))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>")
    found = matrix.pca_fit(df, 5).orderBy("component").collect()
    assert len(found) == 5 and [r.variance for r in found[1:]] == [0.0] * 4
    assert found[0].variance == pytest.approx(float(np.linalg.eigvalsh(np.cov(x.T))[-1]))
    basis = np.array([r.loading for r in found])
    assert np.allclose(basis @ basis.T, np.eye(5), atol=1e-8)
    assert matrix.pca_fit(df.limit(1), 5).count() == 1


def test_wide_top_is_one_range_sort(spark):
    df = spark.range(3000).select(F.lit("hot").alias("k"), (F.col("id") * 7 % 3001).alias("v"))
    top = ordering.top_per_key(df, ["k"], ["v"], 1500)
    assert sorted(r.v for r in top.collect()) == sorted(i * 7 % 3001 for i in range(3000))[:1500]
    assert "WindowGroupLimit" not in top._jdf.queryExecution().toString()


def test_doublets_without_a_flag_stay(spark):
    obs = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "cell string, predicted_doublet boolean")
    assert sorted(r.cell for r in qc.drop_predicted_doublets(obs).collect()) == ["b", "c"]


@pytest.mark.parametrize("bracket", [1 << 16, 4])
def test_quantiles_without_a_sort_of_the_values(spark, monkeypatch, bracket):
    """Ties, tiny and huge numbers, a hot group; with the small limit brackets are narrowed many times."""
    monkeypatch.setattr(ordering, "BRACKET_VALUES", bracket)
    monkeypatch.setattr(ordering, "global_rank", None)
    rng = np.random.default_rng(5)
    sets = {
        "hot": rng.normal(size=4000), "tied": np.repeat([0.0, -0.0, 2.5, 2.5, 7.0], 30), "one": np.array([3.25]),
        "near": 1e6 + np.arange(50) * 2.0**-33, "wide": np.r_[10.0 ** rng.uniform(-300, 300, 60), -(10.0 ** rng.uniform(-300, 300, 41))],
        "tiny": rng.normal(size=99) * 1e-310, None: rng.integers(0, 9, 40).astype(float),
    }
    df = spark.createDataFrame([(g, float(v)) for g, x in sets.items() for v in x] + [("hot", None)], "g string, v double")
    got = {r.g: r for r in exact_quantiles(df.repartition(5), ["g"], "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}).collect()}
    assert set(got) == set(sets)
    for g, x in sets.items():
        assert got[g].n == len(x)
        at = np.array([0.0, 0.25, 0.5, 0.9, 1.0]) * (len(x) - 1)
        lo, hi = np.sort(x)[np.floor(at).astype(int)], np.sort(x)[np.ceil(at).astype(int)]
        assert [got[g][c] for c in "abcde"] == [a + (b - a) * w if a != b else a for a, b, w in zip(lo, hi, at - np.floor(at))]


def test_quantiles_of_infinite_values_and_of_nothing(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([("a", x) for x in (-inf, -1.0, 2.0, inf, inf)] + [("b", 1.0), ("b", nan), ("b", 5.0)], "g string, v double")
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", {"lo": 0.0, "m": 0.5, "hi": 1.0}).collect()}
    assert (got["a"].lo, got["a"].m, got["a"].hi) == (-inf, 2.0, inf)
    assert (got["b"].lo, got["b"].m) == (1.0, 5.0) and math.isnan(got["b"].hi)
    assert exact_quantiles(df.limit(0), ["g"], "v", {"m": 0.5}).collect() == []


@pytest.mark.parametrize("name", ["hvg_select", "top_expressed_genes"])
def test_good_cells_are_found_once(spark, tmp_path, name):
    """Cells that passed the filters are read from their written table, not filtered again wherever they are used."""
    from celltrace.plans import count_queries, registry  # noqa: F401

    n = 25
    spark.createDataFrame([(c, c % 2, "BUILDING") for c in range(n)], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(c, c) for c in range(n)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(p, f"blue {p}", "b", "SMALL", 1) for p in range(n)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    lines = [(c, p, 1, 30.0 + (c * p) % 7) for c in range(n) for p in range(n)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = registry.QUERIES[name](spark, str(tmp_path))
    assert found.count() == (n if name == "hvg_select" else 20)
    assert "< 20.0" not in found._jdf.queryExecution().optimizedPlan().toString()


def small_tables(spark, tmp_path):
    """25 cells with one order each and a line for each of 25 genes."""
    n = 25
    spark.createDataFrame([(c, c % 2, "BUILDING") for c in range(n)], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(c, c) for c in range(n)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(p, f"blue {p}", "b", "SMALL", 1) for p in range(n)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    lines = [(c, p, 1, 30.0 + (c * p) % 7) for c in range(n) for p in range(n)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    return n, str(tmp_path)


@pytest.mark.parametrize("name", ["gene_set_score", "cell_cycle_phase", "phase_proportions"])
def test_line_items_are_read_once(spark, tmp_path, monkeypatch, name):
    from celltrace.plans import marker_queries, proxies, registry  # noqa: F401

    scans = []

    def counted(df):
        scans.append(len(re.findall(r"Relation *\[[^\]]*l_quantity#", df._jdf.queryExecution().optimizedPlan().toString())))
        return cut(df)

    monkeypatch.setattr(proxies, "cut", counted)
    n, folder = small_tables(spark, tmp_path)
    assert registry.QUERIES[name](spark, folder).count() == (1 if name == "phase_proportions" else n)
    assert sum(scans) == 1, scans


def test_sizes_of_matrix_files_come_from_their_lines(spark, tmp_path):
    """The size line of a sample takes the numbers of its cell and gene lines; counting them anew multiplied the rows to be shuffled."""
    from celltrace.plans import registry, source_queries  # noqa: F401

    n, folder = small_tables(spark, tmp_path)
    found = registry.QUERIES["read_mtx"](spark, folder)
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = [(str(c % 2), str(c), f"g{p}", 30.0 + (c * p) % 7) for c in range(n) for p in range(n)]
    assert rows(found, "sample", "cell", "gene", "x") == sorted(want)
