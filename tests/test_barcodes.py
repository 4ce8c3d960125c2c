import pytest

from celltrace.operators import barcodes as b
from celltrace.sources import files
from tests.conftest import rows


def write(path, text):
    path.write_text(text)
    return str(path)


@pytest.fixture
def inputs(spark, tmp_path):
    library = files.read_library_lines(spark, write(tmp_path / "lib.txt", "AAC\tz\n\nggt\n aac \nTTN\n"))
    mincuts = files.read_mincut_lines(spark, write(tmp_path / "cut.txt", "3\nx\n9\n"))
    folder = tmp_path / "csv"
    folder.mkdir()
    write(folder / "S1_seg_assemble.csv", "cb,polylox\nC1,AAC\nc1 ,GGT\nC2,CCC\nC3,TTN\nC3,TTN\n,AAC\n")
    write(folder / "S2_seg_assemble.csv", "n,polylox,cb\n1,GGT,C1\n")
    write(folder / "S3_seg_assemble.csv", "cb,other\nC1,AAC\n")
    rare = files.read_rare_table(spark, write(tmp_path / "rare.txt", "PolyloxBC\tBarcode\tS1\n\tGGT\t1e-7\n\tCCC\t1e-9\n\tGGT\t0.5\n\tTTN\t\n"))
    mouse = files.read_sample_mouse(spark, write(tmp_path / "map.txt", "S1\tM1\nS2\tM1\nS1\tM9\nS4\t\n"))
    return library, mincuts, str(folder), rare, b.sample_map_first(mouse)


def test_library_is_cut_to_the_shorter_file_and_keeps_first(spark, inputs):
    library, mincuts, *_ = inputs
    assert rows(b.barcode_library(library, mincuts), "barcode", "mincut") == [("AAC", 3), ("GGT", 2)]


def test_assignment(spark, inputs):
    library, mincuts, folder, rare, mouse = inputs
    assert rows(mouse) == [("S1", "M1"), ("S2", "M1")]
    assemblies, skipped = files.read_assemblies(spark, folder, ["S1", "S2", "S3", "S7"])
    assert sorted(skipped) == ["S3", "S7"]
    assert {r.sample for r in files.read_assemblies(spark, folder, None)[0].collect()} == {"S1", "S2"}
    with pytest.raises(ValueError):  # the built-in samples are not there
        files.read_assemblies(spark, folder)
    lib = b.barcode_library(library, mincuts)
    long = b.rare_pgen_long(rare)
    assert rows(long) == [("CCC", "S1", 1e-9), ("GGT", "S1", 1e-7)]
    candidates = b.candidate_barcodes(assemblies, mouse, lib, long)
    assert rows(candidates.select("sample", "cb", "polylox", "pgen", "mincut").distinct()) == [
        ("S1", "C1", "AAC", 1.0, 3), ("S1", "C1", "GGT", 1e-7, 2), ("S1", "C2", "CCC", 1e-9, 2),
        ("S1", "C3", "TTN", 1e-8, 2), ("S2", "C1", "GGT", 1.0, 2),
    ]
    obs = spark.createDataFrame([("S1", "c1-1-0"), ("S1", "C3-1"), ("S2", "C2-1"), ("S9", "C1-1")], "sample string, cell string")
    done = b.barcode_assign(obs, assemblies, mouse, lib, long)
    assert rows(done, "sample", "cell", "mouse", "cb", "polylox", "barcode") == [
        ("S1", "C3-1", "M1", "C3", "TTN", "NAA"),
        ("S1", "c1-1-0", "M1", "C1", "AAC", "GTT"),
        ("S2", "C2-1", "M1", "C2", None, None),
        ("S9", "C1-1", "NoAssign", "C1", None, None),
    ]
    report = b.assignment_report(done).first()
    assert (report.n_total, report.n_matched, report.n_unmatched, report.pct_matched) == (4, 2, 2, 50.0)
    assert done.count() == obs.count()
    plain = b.barcode_assign(obs, assemblies, mouse, lib, long, use_reverse_complement=False)
    assert rows(plain.filter("cell = 'C3-1'"), "barcode") == [("TTN",)]
    assert rows(b.unmapped_samples(obs, mouse)) == [("S9",)]


def test_choice_among_candidates(spark):
    nan = float("nan")
    data = [("S", "M", "C", "p0", 0.5, 4, 0), ("S", "M", "C", "p1", 0.5, 2, 1), ("S", "M", "C", "p2", 0.5, 2, 2), ("S", "M", "C", "p3", nan, 1, 3)]
    df = spark.createDataFrame(data, "sample string, mouse string, cb string, polylox string, pgen double, mincut int, row_no long")
    assert rows(b.best_barcode_per_cell(df), "polylox", "mincut") == [("p1", 2)]


def test_rare_value_that_is_no_number_leaves_pgen_missing(spark):
    df = spark.createDataFrame([("S", "A", 1.0)], "sample string, polylox string, pgen double")
    rare = b.rare_pgen_long(spark.createDataFrame([(1, "a", "bad"), (2, "a", "0.5")], "line_no long, barcode string, S string"))
    assert rows(b.pgen_override(df, rare), "pgen") == [(None,)]


def test_key_column_needs_a_value(spark):
    df = spark.createDataFrame([(None, "A")], "PolyloxBC string, Barcode string")
    assert b.rare_key_column(df) == "Barcode"
    with pytest.raises(ValueError):
        b.rare_key_column(spark.createDataFrame([("x",)], "other string"))


def test_requested_samples_and_stale_columns(spark):
    mouse = spark.createDataFrame([("A", "M")], "sample string, mouse string")
    req = spark.createDataFrame([("A",), ("B",)], "sample string")
    assert rows(b.requested_samples(req, mouse)) == [("A", "M", True), ("B", None, False)]
    obs = spark.createDataFrame([("A", "x", "old", 1.0)], "sample string, cell string, barcode string, pGen double")
    assert b.drop_stale(obs).columns == ["sample", "cell"]


def test_built_in_map(spark):
    assert files.read_sample_mouse(spark).count() == 12
