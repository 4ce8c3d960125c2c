import pytest

from pyspark.sql import functions as F

from celltrace.functions import scalars as s


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column).first()[0]


def test_reverse_complement(spark):
    assert one(spark, s.reverse_complement("c"), "acgtn1") == "1NACGT"
    assert one(spark, s.reverse_complement("c"), None) is None
    assert one(spark, s.reverse_complement(s.reverse_complement("c")), "GATTACAN") == "GATTACAN"


def test_cell_barcode(spark):
    assert one(spark, s.cell_barcode("c"), "acgtACGTACGTACGTTT-1-0") == "ACGTACGTACGTACGT"
    assert one(spark, s.cell_barcode("c"), "\tc1 -1") == "C1"


def test_keys_are_stripped_of_any_blank(spark):
    assert one(spark, s.normal_key("c"), "\t aAc \n") == "AAC"


def test_numbers(spark):
    assert one(spark, s.lenient_double("c"), " 1e-7 ") == 1e-7
    assert one(spark, s.lenient_double("c"), "x") is None
    assert one(spark, s.lenient_double("c"), "nan") is None
    for text in ("1d", "5f", "0x1p3", "1_0", "", "1e", ".", "٣"):
        assert one(spark, s.lenient_double("c"), text) is None, text
    assert one(spark, s.lenient_double("c"), "-.5E+2") == -50 and one(spark, s.lenient_double("c"), "inf") == float("inf")
    assert one(spark, s.strict_double("c"), " 2.5 ") == 2.5 and one(spark, s.strict_double("c"), "NaN") is None
    with pytest.raises(Exception):
        one(spark, s.strict_double("c"), "bad")
    assert one(spark, s.truncated_int("c", 2), "2.7") == 2
    assert one(spark, s.truncated_int("c", 2), "3e10") == 30_000_000_000
    assert one(spark, s.truncated_int("c", 2), "1e30") is None
    assert one(spark, s.truncated_int("c", 2), "x") == 2


def test_true_label_is_strict(spark):
    assert one(spark, s.true_barcode_label("c"), 1e-6, "double") == "Not True barcodes"
    assert one(spark, s.true_barcode_label("c"), 9e-7, "double") == "True barcodes"
    assert one(spark, s.true_barcode_label("c"), None, "double") == "Not True barcodes"
    assert one(spark, s.below_cutoff("c"), float("nan"), "double") is False


def test_missing_cell_type_passes(spark):
    df = spark.createDataFrame([("Doublets",), (None,), ("HSPC",)], "c string")
    assert df.filter(s.not_doublet("c")).count() == 2


def test_names(spark):
    assert one(spark, s.capitalize("c"), "HLA-DRA b") == "Hla-dra b"
    assert one(spark, s.safe_id("c"), "My Smp(1)") == "My_Smp_1_"
    assert one(spark, s.fastq_sample("c"), "X_S1_L001_I1_001.fastq.gz") is None
    assert one(spark, s.fastq_sample("c"), "X_S1_L001_R2_001.fq.gz") == "X"
    assert one(spark, s.is_mitochondrial("c"), "MT-CO1") and not one(spark, s.is_mitochondrial("c"), "Mt-x")
    assert one(spark, s.joined_names(F.lit(None).cast("array<string>")), "x") == ""


def test_count_class(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 6, 7, 99, 500)], "n long")
    assert [r[0] for r in df.select(s.count_class("n")).collect()] == [0, 1, 6, 7, 7, 7]


def test_group_names(spark):
    df = spark.createDataFrame([("0",), ("14",), ("9",), (None,)], "c string")
    names = {"0": "Endothelial cells", "14": "Mesenchymal type"}
    assert [r[0] for r in df.select(s.renamed_group("c", names)).collect()] == ["Endothelial cells", "Mesenchymal type", None, None]


def test_missing_texts_are_compared_as_they_stand(spark):
    for text in ("<NA>", "#N/A N/A", "-1.#IND", "1.#IND", "-1.#QNAN", "1.#QNAN", "NA", ""):
        assert one(spark, s.missing_to_null("c"), text) is None, text
    assert one(spark, s.missing_to_null("c"), " NA ") == " NA "
