from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.mark.parametrize("name", ["barcode_assign", "linked_barcodes_other", "hvg_select", "ora_scores", "phase_proportions", "bh_adjust", "fuzzy_graph"])
def test_query_equals_sql(spark, name):
    ok, note = compare(spark, connect(FOLDER), FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, note


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    own = {name for name in entry.queries() if not (name == "pipeline" or name.startswith("op") and name[2:3].isdigit())}
    assert own - set(entry.oracle_sql()) == {
        "approximate_knn", "communities", "graph_layout", "pca_scores", "pca_variance", "source_rankings", "doublet_scores", "doublet_calls"}
