import gzip

import pytest

from celltrace.sources import files, tables
from tests.conftest import rows


def put(path, text, packed=False):
    path.parent.mkdir(parents=True, exist_ok=True)
    if packed:
        with gzip.open(path, "wt") as out:
            out.write(text)
    else:
        path.write_text(text)


@pytest.fixture
def matrices(tmp_path):
    head = "%%MatrixMarket matrix coordinate integer general\n%meta\n"
    a = tmp_path / "SmpA" / files.MATRIX_DIR
    # The last entry has the same place as the size line, with the same value.
    put(a / "matrix.mtx.gz", head + "3 2 3\n1 1 4\n2 1 1\n3 2 3\n", True)
    put(a / "barcodes.tsv.gz", "AA-1\nCC-1\n", True)
    put(a / "features.tsv.gz", "i1\tG\tGene Expression\ni2\tG\tGene Expression\ni3\tmt-a\tGene Expression\n", True)
    b = tmp_path / "SmpB" / files.MATRIX_DIR
    put(b / "matrix.mtx", head + "2 1 1\n1 1 7\n")
    put(b / "barcodes.tsv", "AA-1\n")
    put(b / "features.tsv", "i1\tG\ni9\tH\n")
    put(tmp_path / "SmpC" / "other" / "x.txt", "x")
    return tmp_path


def test_discovery_and_matrices(spark, matrices):
    listed = files.list_files(spark, str(matrices))
    found = files.discover_samples(listed)
    assert rows(found, "sample", "found") == [("SmpA", True), ("SmpB", True), ("SmpC", False)]
    asked = files.discover_samples(listed, spark.createDataFrame([("Zz", 1), ("SmpB", 2), ("SmpA", 3), ("Zz", 9)], "sample string, place long"))
    assert rows(asked, "place", "sample", "matrix_dir", "found") == [
        (1, "Zz", None, False), (2, "SmpB", f"SmpB/{files.MATRIX_DIR}", True), (3, "SmpA", f"SmpA/{files.MATRIX_DIR}", True)]
    with pytest.raises(FileNotFoundError):
        files.require_samples(found.filter("sample = 'SmpC'"))
    counts, cells, genes = files.read_10x(spark, str(matrices), ["SmpA", "SmpB"])
    assert rows(counts) == [("SmpA", "AA-1", "G", 4.0), ("SmpA", "AA-1", "G-1", 1.0), ("SmpA", "CC-1", "mt-a", 3.0), ("SmpB", "AA-1", "G", 7.0)]
    assert cells.count() == 3 and genes.count() == 5


def test_all_discovered_samples_and_packed_files_first(spark, matrices):
    put(matrices / "SmpB" / files.MATRIX_DIR / "matrix.mtx.gz", "%%MatrixMarket matrix coordinate integer general\n2 1 1\n2 1 9\n", True)
    counts, *_ = files.read_10x(spark, str(matrices))  # SmpC has no matrix folder
    assert rows(counts.filter("sample = 'SmpB'")) == [("SmpB", "AA-1", "H", 9.0)] and counts.count() == 4
    report = {r.sample: (len(r.files), r.missing) for r in files.matrix_report(spark, str(matrices), ["SmpB", "Zz"]).collect()}
    assert report == {"SmpB": (3, []), "Zz": (0, ["matrix.mtx", "barcodes.tsv", "features.tsv"])}
    with pytest.raises(FileNotFoundError):
        files.read_10x(spark, str(matrices), ["SmpB", "Zz"])
    with pytest.raises(FileNotFoundError):
        files.read_10x(spark, str(matrices / "SmpC"))


def test_assemblies_of_any_header_in_one_read(spark, tmp_path):
    put(tmp_path / "SmpA_seg_assemble.csv", "cb,polylox\nAA,1_2\n\nCC,nan\n")
    put(tmp_path / "SmpB_seg_assemble.csv.gz", 'x,"polylox",n,cb\n"a,b",3_4,7,GG\ny,5_6,8,TT\n', True)
    put(tmp_path / "SmpB_seg_assemble.csv", "cb,polylox\nold,old\n")
    put(tmp_path / "SmpC_seg_assemble.csv", "cb,other\nAA,1\n")
    put(tmp_path / "SmpD_seg_assemble.csv", "cb,polylox\nZZ,9_9\n")
    put(tmp_path / "deep" / "SmpA_seg_assemble.csv", "cb,polylox\nno,no\n")
    found, status = files.scan_assemblies(spark, str(tmp_path), ["SmpA", "SmpB", "SmpC", "Zz"])
    assert rows(status) == [("SmpA", "read"), ("SmpB", "read"), ("SmpC", "no cb, polylox"), ("Zz", "missing")]
    assert [(r.sample, r.cb, r.polylox) for r in found.orderBy("sample", "row_no").collect()] == [
        ("SmpA", "AA", "1_2"), ("SmpA", "CC", None), ("SmpB", "GG", "3_4"), ("SmpB", "TT", "5_6")]
    table, skipped = files.read_assemblies(spark, str(tmp_path), ["Zz", "SmpC", "SmpD"])
    assert skipped == ["Zz", "SmpC"] and rows(table, "sample", "cb") == [("SmpD", "ZZ")]
    table, skipped = files.read_assemblies(spark, str(tmp_path), None)
    assert skipped == ["SmpC"] and table.count() == 5
    with pytest.raises(ValueError):
        files.read_assemblies(spark, str(tmp_path), ["SmpC"])


def test_other_feature_types_are_no_genes(spark, tmp_path):
    top = tmp_path / "SmpA" / files.MATRIX_DIR
    put(top / "matrix.mtx", "%%MatrixMarket matrix coordinate integer general\n%\n3 1 3\n1 1 4\n2 1 9\n3 1 5\n")
    put(top / "barcodes.tsv", "AA-1\n")
    put(top / "features.tsv", "i1\tG\tGene Expression\nab\tG\tAntibody Capture\ni3\tG\tGene Expression\n")
    counts, _, genes = files.read_10x(spark, str(tmp_path), ["SmpA"])
    assert rows(counts, "gene", "x") == [("G", 4.0), ("G-1", 5.0)] and genes.count() == 2


def test_line_numbers_skip_blank_lines_per_file(spark, tmp_path):
    put(tmp_path / "a.txt", "x\n\ny\n")
    put(tmp_path / "b.txt", "\nz\n")
    got = files.numbered_lines(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")])
    assert rows(got, "value", "line_no") == [("x", 1), ("y", 2), ("z", 1)]


def test_line_numbers_across_blocks(spark, tmp_path):
    put(tmp_path / "big.txt", "".join(f"line-{i:05d}\n" for i in range(1, 4001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = files.numbered_lines(spark, str(tmp_path / "big.txt"))
        assert spark.read.text(str(tmp_path / "big.txt")).rdd.getNumPartitions() > 1
        assert got.filter("CAST(substr(value, 6) AS INT) <> line_no").count() == 0 and got.count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_read_files_and_manifest(spark, tmp_path):
    for name in ("a/My Smp_S1_L001_R1_001.fastq.gz", "b/My Smp_S1_L002_R2_001.fastq.gz", "a/X_S1_L001_I1_001.fastq.gz",
                 "scripts/X_S1_L001_R1_001.fastq.gz", "a/scripts/X_S1_L001_R1_001.fq.gz", "top_S1_L001_R1_001.fq.gz", "a/n.txt"):
        put(tmp_path / name, "x")
    found = files.fastq_samples(files.list_files(spark, str(tmp_path)), "/root")
    assert rows(found) == [("My Smp", ["/root/a", "/root/b"]), ("X", ["/root/a/scripts"]), ("top", ["/root"])]
    job = files.job_manifest(found, "/root", "/ref").filter("sample = 'My Smp'").first()
    assert job.run_id == "My_Smp" and job.fastq_dirs == "/root/a,/root/b"
    assert '--sample="My Smp"' in job.command and job.swarm_line == "bash /root/scripts/cellranger_count_My_Smp.sh"


def test_reference_pick(spark):
    def pick(*paths):
        return files.pick_reference_dir(spark.createDataFrame([(p,) for p in paths], "path string")).first()[0]

    assert pick("mm/b/fasta/genome.fa", "mm/b/genes/x", "mm/a/fasta/genome.fa", "mm/a/star/x", "hs/fasta/g") == "mm/a"
    assert pick("fasta/genome.fa", "genes/x") == "" and pick("a/fasta/g", "x") == ""


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s", "c", 1.0)], "sample string, cell string, x double")
    tables.write_table(df, str(tmp_path / "t"))
    assert rows(tables.read_table(spark, str(tmp_path / "t")), "sample", "cell", "x") == [("s", "c", 1.0)]
    tables.write_report(df, str(tmp_path / "r"))
    assert spark.read.csv(str(tmp_path / "r"), sep="\t", header=True).columns == ["sample", "cell", "x"]
    tables.write_parameters(spark, {"min_genes": 200}, str(tmp_path / "p"))
    assert spark.read.json(str(tmp_path / "p")).first().min_genes == 200
