import pytest
from pyspark.errors import PySparkValueError
from pyspark.sql import functions as F

from celltrace.sources import annotated
from tests.conftest import rows


@pytest.fixture
def cells(spark):
    return spark.createDataFrame([("01", "a", 5), ("01", "b", 7), ("x y", "a", None)], "sample string, cell string, n int")


@pytest.fixture
def folder(cells, tmp_path):
    place = str(tmp_path / "set")
    assert annotated.create_cells(cells, place) == 1
    return place


def test_two_steps_in_turn(spark, folder):
    first = spark.createDataFrame([("01", "a", "3"), ("01", "zz", "9"), (None, "a", "1")], "sample string, cell string, leiden string")
    second = spark.createDataFrame([("x y", "a", 0.5, True), ("01", "a", 0.25, False)], "sample string, cell string, score double, doublet boolean")
    assert annotated.append_columns(first, folder, "clusters") == 2
    assert annotated.append_columns(second, folder, "doublets") == 3
    got = annotated.read_cells(spark, folder)
    assert got.columns == ["sample", "cell", "n", "leiden", "score", "doublet"]
    assert rows(got) == [("01", "a", 5, "3", 0.25, False), ("01", "b", 7, None, None, None), ("x y", "a", None, None, 0.5, True)]
    assert rows(annotated.read_cells(spark, folder, version=1)) == [("01", "a", 5), ("01", "b", 7), ("x y", "a", None)]
    assert rows(annotated.read_cells(spark, folder, ["score"], ["x y"])) == [("x y", "a", 0.5)]


def test_only_needed_groups_and_folders_are_read(spark, folder):
    annotated.append_columns(spark.createDataFrame([("01", "a", 1)], "sample string, cell string, k int"), folder, "other")
    files = annotated.read_cells(spark, folder, ["n"], ["01"]).inputFiles()
    assert files and not any("other-" in f for f in files)
    plan = annotated.read_cells(spark, folder, ["n"], ["01"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(sample" in plan or "PartitionFilters: [sample" in plan


def test_a_step_run_again_replaces_its_columns(spark, folder):
    once = spark.createDataFrame([("01", "a", 1, 1), ("01", "b", 2, 2)], "sample string, cell string, k int, m int")
    annotated.append_columns(once, folder, "step")
    annotated.append_columns(once.select("sample", "cell", (F.col("k") * 10).cast("string").alias("k")).filter("cell = 'b'"), folder, "step")
    assert rows(annotated.read_cells(spark, folder, ["k", "m"])) == [("01", "a", None, 1), ("01", "b", "20", 2), ("x y", "a", None, None)]
    annotated.append_columns(once.select("sample", "cell", F.col("k").alias("n")), folder, "n")
    got = annotated.read_cells(spark, folder)
    assert sorted(got.columns) == ["cell", "k", "m", "n", "sample"] and rows(got, "sample", "cell", "n") == [("01", "a", 1), ("01", "b", 2), ("x y", "a", None)]


def test_a_failed_write_leaves_the_old_state(spark, folder):
    bad = spark.createDataFrame([("01", "a", 1), ("01", "b", 2)], "sample string, cell string, k int")
    broken = bad.withColumn("k", F.when(F.col("k") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("k")))
    with pytest.raises(Exception, match="lost"):
        annotated.append_columns(broken, folder, "step")
    with pytest.raises(Exception, match="repeated cell 01 a"):
        annotated.append_columns(bad.union(bad.limit(1)), folder, "step")
    assert annotated.versions(spark, folder) == [1] and annotated.read_cells(spark, folder).columns == ["sample", "cell", "n"]
    annotated.append_columns(bad, folder, "step")
    gone = annotated.drop_unused(spark, folder)
    assert len(gone) <= 2 and all(name.startswith("step-") for name in gone)
    assert annotated.versions(spark, folder) == [2] and rows(annotated.read_cells(spark, folder, ["k"]))[0] == ("01", "a", 1)


def test_two_writers_at_once_both_get_in(spark, folder, monkeypatch):
    one = spark.createDataFrame([("01", "a", 1)], "sample string, cell string, k int")
    commit, turns = annotated._commit, []

    def late(session, place, content):
        if not turns:
            turns.append(1)
            annotated.append_columns(one.withColumnRenamed("k", "m"), folder, "other")
        return commit(session, place, content)

    monkeypatch.setattr(annotated, "_commit", late)
    assert annotated.append_columns(one, folder, "mine") == 3
    assert rows(annotated.read_cells(spark, folder))[0] == ("01", "a", 5, 1, 1) and annotated.versions(spark, folder) == [1, 2, 3]


def test_what_is_refused(spark, cells, folder, tmp_path):
    for call in (
        lambda: annotated.create_cells(cells, folder), lambda: annotated.append_columns(cells.select("sample", "cell"), folder, "x"),
        lambda: annotated.append_columns(cells, str(tmp_path / "none"), "x"), lambda: annotated.read_cells(spark, folder, ["zz"]),
        lambda: annotated.read_cells(spark, folder, version=9),
    ):
        with pytest.raises(PySparkValueError):
            call()
    assert not (tmp_path / "none").exists()


def test_no_cells(spark, cells, tmp_path):
    place = str(tmp_path / "empty")
    annotated.create_cells(cells.limit(0), place)
    annotated.append_columns(cells.limit(0).withColumnRenamed("n", "k"), place, "step")
    assert annotated.read_cells(spark, place).collect() == [] and annotated.read_cells(spark, place).columns == ["sample", "cell", "n", "k"]
