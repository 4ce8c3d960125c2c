import pytest

from celltrace.operators import sharing as sh
from tests.conftest import rows

OBS = [
    ("b1", "HSPC", 1e-8), ("b1", "HSPC", 1e-8), ("b1", "Endothelial cells", 1e-8), ("b2", "HSPC", 1e-8), ("b3", "Doublets", 1e-8),
    ("b4", "HSPC", 1e-6), ("b5", "Endothelial cells", None), ("b6", None, 1e-8), (None, "HSPC", 1e-8),
]


@pytest.fixture
def obs(spark):
    return spark.createDataFrame(OBS, "barcode string, cell_type string, pgen double")


def test_table(obs):
    assert rows(sh.barcode_celltype_table(obs)) == [("b1", "Endothelial cells", 1), ("b1", "HSPC", 2), ("b2", "HSPC", 1), ("b3", "Doublets", 1)]
    assert "b3" not in {r[0] for r in rows(sh.barcode_celltype_table(obs, doublets="drop_rows"))}


def test_linked_keeps_zero_rows(obs):
    out = sh.linked_barcodes(sh.barcode_celltype_table(obs), "HSPC", False)
    got = rows(out, "row_rank", "cell_type", "row_total", "col_rank", "barcode", "col_total", "n")
    assert got == [
        (1, "HSPC", 3, 1, "b1", 3, 2), (1, "HSPC", 3, 2, "b2", 1, 1),
        (2, "Endothelial cells", 1, 1, "b1", 3, 1), (2, "Endothelial cells", 1, 2, "b2", 1, 0),
        (3, "Doublets", 0, 1, "b1", 3, 0), (3, "Doublets", 0, 2, "b2", 1, 0),
    ]


def test_linked_pins_the_target(obs):
    out = sh.linked_barcodes(sh.barcode_celltype_table(obs), "Endothelial cells", True)
    assert rows(out, "row_rank", "cell_type", "barcode", "n") == [(1, "Endothelial cells", "b1", 1), (2, "HSPC", "b1", 2), (3, "Doublets", "b1", 0)]


def test_missing_target_gives_empty_table(obs):
    out = sh.linked_barcodes(sh.barcode_celltype_table(obs), "Mesenchymal type", True)
    assert out.count() == 0 and "col_rank" in out.columns


def test_only_target_type_is_not_filtered(spark):
    table = spark.createDataFrame([("b1", "HSPC", 2)], "barcode string, cell_type string, n long")
    assert sh.linked_barcodes(table, "HSPC", True).count() == 1


def test_combinations_keep_the_empty_set(obs):
    combos = sh.celltype_combinations(sh.barcode_celltype_table(obs))
    assert rows(combos.selectExpr("array_join(cell_types, '+') AS s", "n", "degree")) == [("", 1, 0), ("Endothelial cells+HSPC", 1, 2), ("HSPC", 1, 1)]
    assert rows(sh.celltype_barcode_totals(sh.barcode_celltype_table(obs))) == [("Endothelial cells", 1), ("HSPC", 2)]


def test_labels_and_page(spark, obs):
    labelled = sh.label_true_barcodes(obs)
    assert {r[0] for r in rows(labelled.filter("true_bc = 'Not True barcodes'"), "barcode")} == {"b4", "b5"}
    assert sh.plottable_cells(obs).count() == 7
    page = sh.barcode_list_page(spark.createDataFrame([(f"x{i}", "True barcodes") for i in range(7)], "barcode string, true_bc string"))
    assert rows(page.filter("barcode = 'x6'"), "page_col", "page_row") == [(3, 0)]


def test_ordered_and_presence(obs):
    table = sh.barcode_celltype_table(obs, doublets="drop_rows")
    ordered = sh.ordered_table(table)
    assert rows(ordered.filter("barcode = 'b1'"), "cell_type", "col_rank", "row_rank") == [("Endothelial cells", 2, 1), ("HSPC", 1, 1)]
    assert ("barcode", "b1", 2) in rows(sh.presence_counts(table), "axis", "name", "n_present")


def test_text_pgen(spark):
    obs = spark.createDataFrame([("b1", "HSPC", "1e-8"), ("b2", "HSPC", "bad"), ("b3", "HSPC", "1d"), ("nan", "HSPC", "1e-9")], "barcode string, cell_type string, pgen string")
    assert {r.barcode: r.true_bc for r in sh.label_true_barcodes(obs).collect()} == {
        "b1": "True barcodes", "b2": "Not True barcodes", "b3": "Not True barcodes", "nan": "True barcodes"}
    assert [r[0] for r in rows(sh.barcode_celltype_table(obs))] == ["b1", "nan"]
    assert [r[0] for r in rows(sh.barcode_celltype_table(obs, present_only=True))] == ["b1"]
    with pytest.raises(Exception):
        sh.barcode_celltype_table(obs, strict=True).collect()


def test_sets_put_the_priority_type_first(spark):
    table = spark.createDataFrame(
        [("b1", "Astro", 1), ("b1", "Endothelial cells", 2), ("b2", "Astro", 1), ("b3", "Doublets", 4), ("b4", "Astro", 1), ("b5", "Zeta", 1)],
        "barcode string, cell_type string, n long")
    got = [(r.place, list(r.cell_types), r.n) for r in sh.celltype_combinations(table).orderBy("place").collect()]
    assert got == [(1, [], 1), (2, ["Astro"], 2), (3, ["Zeta"], 1), (4, ["Endothelial cells", "Astro"], 1)]
