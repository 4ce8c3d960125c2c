"""Text sources of the count and barcode tables, and file listings.

Line order matters in several of these files. A line is placed by the byte
offset of its file block and its place inside the block, both known to the task that
reads it, so no file has to go through one task to be numbered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from celltrace.functions.scalars import fastq_sample, missing_to_null, safe_id
from celltrace.operators.ordering import global_rank
from celltrace.operators.qc import unique_names
from celltrace.session import cut

MATRIX_DIR = "filtered_feature_bc_matrix"
# Folders that hold no reads, and the built-in sample map.
EXCLUDED_TOP = ["cellranger_out", "scripts", "swarm_logs", "Ref"]
DEFAULT_SAMPLE_MOUSE = {
    "Smp1": "Mouse#1", "Smp2": "Mouse#1", "Smp3": "Mouse#1", "Smp4": "Mouse#1",
    "Smp5": "Mouse#2", "Smp6": "Mouse#2", "Smp7": "Mouse#2",
    "SmpA": "Mouse#3", "SmpB": "Mouse#3", "SmpC": "Mouse#3", "SmpD": "Mouse#3",
    "SmpE": "Mouse#4",
}
DEFAULT_SAMPLES = list(DEFAULT_SAMPLE_MOUSE)

_LATE = 1 << 62


def _qualified(spark: SparkSession, path: str) -> str:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop_path).toString()


def _placed_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(path, line_no, value)``: 1-based numbers per file over the lines that are not blank."""
    lines = _placed_lines(spark, paths).filter(F.trim("value") != "")
    sizes = lines.groupBy("path", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("path").orderBy("_block")) - F.col("_n")
    starts = sizes.select("path", "_block", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("path", "_block").orderBy("_row"))
    return lines.withColumn("_in", inside).join(starts, ["path", "_block"]).select(
        "path", (F.col("_before") + F.col("_in")).alias("line_no"), "value"
    )


def _field(index: int):
    return F.get(F.split("value", "\t"), F.lit(index))


def read_library_lines(spark: SparkSession, path: str) -> DataFrame:
    """First column of a header-less table, with line numbers."""
    return numbered_lines(spark, path).select("line_no", missing_to_null(_field(0)).alias("barcode"))


def read_mincut_lines(spark: SparkSession, path: str) -> DataFrame:
    return numbered_lines(spark, path).select("line_no", _field(0).alias("mincut"))


def read_sample_mouse(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Sample map from a header-less table, or the built-in one."""
    if path is None:
        return spark.createDataFrame(list(DEFAULT_SAMPLE_MOUSE.items()), "sample string, mouse string")
    lines = numbered_lines(spark, path)
    return lines.select("line_no", missing_to_null(_field(0)).alias("sample"), missing_to_null(_field(1)).alias("mouse"))


def _row_order():
    """Order of rows inside one delimited file."""
    return F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def read_rare_table(spark: SparkSession, path: str) -> DataFrame:
    """Wide rare-pGen table as texts, with the row order as ``line_no``."""
    rows = spark.read.csv(path, sep="\t", header=True)
    return rows.select(_row_order().alias("line_no"), *[F.col(f"`{c}`") for c in rows.columns])


#: Columns of an assembly file that are looked at.
_FIELDS = 64
# Fixed value: the ending of the files with a sample's candidate barcodes.
_ASSEMBLY = "_seg_assemble.csv"
_ASSEMBLY_NAME = rf"^(.*){_ASSEMBLY.replace('.', '[.]')}([.]gz)?$"


def scan_assemblies(spark: SparkSession, base_path: str, samples: list[str] | None = DEFAULT_SAMPLES) -> tuple[DataFrame, DataFrame]:
    """Candidates of the ``<sample>_seg_assemble.csv`` files (plain or gz, gz wins) right under ``base_path``, in one read whatever their headers.

    Returns the rows ``(sample, row_no, cb, polylox)`` and a report ``(sample, status)``: ``read``, ``missing`` or ``no cb, polylox`` for every
    sample asked for (None: every sample found). The files are listed and their headers checked in the tasks; Spark skips the files
    of other samples. Nothing runs before the results are used.
    """
    name = F.url_decode(F.col("_metadata.file_name"))
    sample = F.regexp_extract(name, _ASSEMBLY_NAME, 1)
    lines = spark.read.option("pathGlobFilter", f"*{_ASSEMBLY}*").text(base_path)
    lines = lines.filter(name.rlike(_ASSEMBLY_NAME))
    if samples is not None:
        lines = lines.filter(sample.isin(samples))
    lines = lines.select("value", sample.alias("sample"), name.endswith(".gz").alias("packed"), _row_order().alias("row_no")).filter(F.trim("value") != "")
    # the first line of a file, by its place: one row per file
    heads = lines.groupBy("sample", "packed").agg(F.min_by("value", "row_no").alias("header"), F.min("row_no").alias("first"))
    heads = heads.groupBy("sample").agg(F.max(F.struct("packed", "header", "first")).alias("h")).select("sample", "h.*")
    heads = heads.withColumn("names", F.split(F.regexp_replace(F.regexp_replace("header", "^\ufeff", ""), '"', ""), "\\s*,\\s*"))
    places = heads.select("*", *(F.array_position("names", c).cast("int").alias(f"at_{c}") for c in ("cb", "polylox")))
    usable = (F.col("at_cb") > 0) & (F.col("at_polylox") > 0)
    # fields as texts, whatever their number; a value is quoted or not
    fields = F.from_csv(F.col("value"), ", ".join(f"f{i} string" for i in range(1, _FIELDS + 1)), {"mode": "PERMISSIVE"})
    rows = lines.join(places.filter(usable).drop("header", "names"), ["sample", "packed"]).filter(F.col("row_no") > F.col("first"))
    rows = rows.withColumn("f", fields).withColumn("f", F.array(*(F.col(f"f.f{i}") for i in range(1, _FIELDS + 1))))
    wide = F.greatest("at_cb", "at_polylox") > _FIELDS
    value = {c: F.when(wide, F.raise_error(F.lit(f"cb and polylox must be among the first {_FIELDS} columns"))).otherwise(F.get("f", F.col(f"at_{c}") - 1)) for c in ("cb", "polylox")}
    rows = rows.select("sample", "row_no", *(missing_to_null(v).alias(c) for c, v in value.items()))
    status = places.select("sample", F.when(usable, "read").otherwise("no cb, polylox").alias("status"))
    if samples is not None:
        asked = spark.createDataFrame([(s,) for s in dict.fromkeys(samples)], "sample string")
        status = asked.join(status, "sample", "left").fillna("missing", ["status"])
    return rows, status


def read_assemblies(spark: SparkSession, base_path: str, samples: list[str] | None = DEFAULT_SAMPLES) -> tuple[DataFrame, list[str]]:
    """As ``scan_assemblies``, with the samples left out as a list; without a usable file it is an error."""
    rows, status = scan_assemblies(spark, base_path, samples)
    found = {r["sample"]: r["status"] for r in status.collect()}  # one row per sample
    if "read" not in found.values():
        raise ValueError(f"no usable sample file under {base_path}")
    order = samples if samples is not None else sorted(found)
    return rows, [s for s in order if found[s] == "missing"] + [s for s in order if found[s] not in ("read", "missing")]


# ---- count matrices -------------------------------------------------------------------------


_MATRIX_FILES = ("matrix.mtx", "barcodes.tsv", "features.tsv")
_MATRIX_PATH = rf"([^/]+)/{MATRIX_DIR}/(matrix[.]mtx|barcodes[.]tsv|features[.]tsv)([.]gz)?$"


def matrix_report(spark: SparkSession, root: str, samples: list[str] | None = None) -> DataFrame:
    """``(sample, files, missing)``: the files to read of every sample under ``root`` with a matrix folder, or of those asked for, as paths
    below ``root``, and the names of those that are not there. A packed file goes before a plain one."""
    listed = list_files(spark, root).filter(F.col("path").rlike("^" + _MATRIX_PATH))
    found = listed.groupBy(F.regexp_extract("path", _MATRIX_PATH, 1).alias("sample"), F.regexp_extract("path", _MATRIX_PATH, 2).alias("name"))
    found = found.agg(F.max_by("path", F.length("path")).alias("path"))
    per_sample = found.groupBy("sample").agg(F.array_sort(F.collect_list("path")).alias("files"), F.collect_set("name").alias("names"))
    if samples is not None:
        asked = spark.createDataFrame([(s,) for s in dict.fromkeys(samples)], "sample string")
        per_sample = asked.join(per_sample, "sample", "left")
    every = F.array(*map(F.lit, _MATRIX_FILES))
    none = F.array().cast("array<string>")
    return per_sample.select("sample", F.coalesce("files", none).alias("files"), F.array_except(every, F.coalesce("names", none)).alias("missing"))


# Fixed value: the type of the rows that count genes.
GENE_ROWS = "Gene Expression"


def _gene_lines(feature_lines: DataFrame) -> DataFrame:
    """Lines of gene rows; files without a type column have no others."""
    kind = F.trim(_field(2))
    return feature_lines.filter(kind.isNull() | (kind == "") | (kind == GENE_ROWS))


def counts_from_lines(matrix_lines: DataFrame, barcode_lines: DataFrame, feature_lines: DataFrame) -> DataFrame:
    """Counts ``(sample, cell, gene, x)`` from the lines of matrix, barcode and feature files; rows of other feature types are left out.

    ``matrix_lines(sample, line, value)``: the size line is the first one that is no comment. It
    names the last gene and the last cell, so it can meet only that one entry; the
    two are told apart by ``line``, in the same aggregation that adds repeated entries.
    """
    part = F.split(F.trim("value"), r"\s+")
    entries = (
        matrix_lines.filter((F.trim("value") != "") & ~F.col("value").startswith("%"))
        .select(
            "sample", "line", part[0].cast("long").alias("gene_idx"), part[1].cast("long").alias("cell_idx"), part[2].cast("double").alias("x")
        )
        # One shuffle on the cell serves the aggregation and the join with the cell names.
        .repartition("sample", "cell_idx")
        .groupBy("sample", "cell_idx", "gene_idx")
        .agg(F.sum("x").alias("x"), F.min_by("x", "line").alias("_first"))
    )
    cells = barcode_lines.select("sample", F.col("line_no").alias("cell_idx"), F.trim("value").alias("cell"))
    names = _gene_lines(feature_lines).select("sample", F.col("line_no").alias("idx"), F.coalesce(_field(1), _field(0)).alias("name"))
    genes = unique_names(names, group=["sample"]).select("sample", F.col("idx").alias("gene_idx"), F.col("unique_name").alias("gene"))
    size = (
        cells.groupBy("sample").agg(F.max("cell_idx").alias("_cells"))
        .join(feature_lines.groupBy("sample").agg(F.max("line_no").alias("_genes")), "sample")
    )
    corner = (F.col("cell_idx") == F.col("_cells")) & (F.col("gene_idx") == F.col("_genes"))
    return (
        entries.join(size, "sample")
        .withColumn("x", F.when(corner, F.col("x") - F.col("_first")).otherwise(F.col("x")))
        .filter(F.col("x") != 0)
        .join(cells, ["sample", "cell_idx"])
        .join(genes, ["sample", "gene_idx"])
        .select("sample", "cell", "gene", "x")
    )


def read_10x(spark: SparkSession, root: str, samples: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All samples under ``root`` at once (None: every one that ``discover_samples`` finds there): counts, cells ``(sample, cell)``,
    features ``(sample, idx, gene_id, symbol)``. A sample that lacks a file is an error."""
    if samples is None:
        report = matrix_report(spark, root).join(discover_samples(list_files(spark, root)).filter("found").select("sample"), "sample", "left_semi")
    else:
        report = matrix_report(spark, root, samples)
    report = cut(report)
    lacking = report.filter(F.size("missing") > 0).orderBy("sample").first()
    if lacking:
        raise FileNotFoundError(f"{', '.join(lacking['missing'])} of sample {lacking['sample']} not found under {root}")
    chosen = report.select("sample", F.explode("files").alias("file"))
    if chosen.isEmpty():
        raise FileNotFoundError(f"no sample folder with {MATRIX_DIR}/ found under {root}")

    def of_samples(lines: DataFrame) -> DataFrame:
        """Lines of the chosen files, with their sample; the list of files is small and meets them by its measured size."""
        file = F.url_decode(F.regexp_extract("path", rf"([^/]+/{MATRIX_DIR}/[^/]+)$", 1))
        return lines.withColumn("file", file).join(chosen, "file").drop("file")

    everywhere = lambda name: f"{root.rstrip('/')}/*/{MATRIX_DIR}/{name}*"
    matrix = of_samples(_placed_lines(spark, everywhere("matrix.mtx"))).select(
        "sample",
        # The size line lies in the first block; later blocks only need to sort after it.
        F.when(F.col("_block") == 0, F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))).otherwise(F.lit(_LATE)).alias("line"),
        "value",
    )
    barcodes = of_samples(numbered_lines(spark, everywhere("barcodes.tsv")))
    features = of_samples(numbered_lines(spark, everywhere("features.tsv")))
    counts = counts_from_lines(matrix, barcodes, features)
    cells = barcodes.select("sample", F.trim("value").alias("cell"))
    genes = _gene_lines(features).select("sample", F.col("line_no").alias("idx"), _field(0).alias("gene_id"), _field(1).alias("symbol"))
    return counts, cells, genes


# ---- listings -------------------------------------------------------------------------------


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Files below ``root`` that are not empty: path relative to it and full path; contents are not read."""
    base = _qualified(spark, root).rstrip("/") + "/"
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return listed.select(F.col("path").substr(F.lit(len(base) + 1), F.length("path")).alias("path"), F.col("path").alias("full_path"))


def discover_samples(paths: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """Samples with a matrix folder: ``(sample, matrix_dir, found)``. With ``requested`` its samples
    are answered in its order (``place``, by its column of that name or else by name), without it every top folder is, by name."""
    top = F.regexp_extract("path", r"^([^/]+)/", 1)
    inside = F.col("path").rlike(rf"^[^/]+/{MATRIX_DIR}/")
    seen = paths.select(top.alias("sample"), inside.alias("_in")).filter("sample <> ''").groupBy("sample").agg(F.bool_or("_in").alias("found"))
    order = "sample"
    if requested is not None:
        order = "place" if "place" in requested.columns else "sample"
        asked = requested.groupBy("sample").agg(F.min(order).alias("_order"))
        seen = asked.join(seen, "sample", "left").withColumn("found", F.coalesce("found", F.lit(False)))
    else:
        seen = seen.withColumn("_order", F.col("sample"))
    placed = global_rank(seen, ["_order", "sample"], "place")
    return placed.select("sample", F.when(F.col("found"), F.concat("sample", F.lit(f"/{MATRIX_DIR}"))).alias("matrix_dir"), "found", "place")


def require_samples(discovered: DataFrame) -> DataFrame:
    valid = discovered.filter("found")
    if valid.isEmpty():
        raise FileNotFoundError(f"no sample folder with {MATRIX_DIR}/ found")
    return valid


def fastq_samples(paths: DataFrame, root: str = "") -> DataFrame:
    """Sample and its folders of read files, index reads and excluded top folders left out."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    top = F.regexp_extract("path", r"^([^/]+)/", 1)
    folder = F.regexp_replace(F.regexp_extract("path", r"^(.*/)?[^/]+$", 1), "/$", "")
    prefix = root.rstrip("/")
    full = F.when(folder == "", F.lit(prefix)).otherwise(F.concat(F.lit(prefix + "/" if prefix else ""), folder))
    return (
        paths.filter(F.col("path").endswith(".fastq.gz") | F.col("path").endswith(".fq.gz"))
        .filter(~top.isin(EXCLUDED_TOP))
        .select(fastq_sample(name).alias("sample"), full.alias("dir"))
        .filter(F.col("sample").isNotNull())
        .distinct()
        .groupBy("sample")
        .agg(F.array_sort(F.collect_list("dir")).alias("dirs"))
    )


def job_manifest(samples: DataFrame, root: str, ref_dir: str) -> DataFrame:
    """One counting job per sample: safe id, comma-joined folders, command and submission line."""
    run_id = safe_id("sample")
    fastqs = F.array_join("dirs", ",")
    command = F.format_string(
        'cellranger count --id="%s" --transcriptome="%s" --fastqs="%s" --sample="%s" --localcores=16 --localmem=100 --create-bam=true',
        run_id, F.lit(ref_dir), fastqs, F.col("sample"),
    )
    return samples.select(
        "sample", run_id.alias("run_id"), fastqs.alias("fastq_dirs"), command.alias("command"),
        F.format_string("bash %s/scripts/cellranger_count_%s.sh", F.lit(root.rstrip("/")), run_id).alias("swarm_line"),
    )


def pick_reference_dir(paths: DataFrame) -> DataFrame:
    """First folder (by path) holding ``fasta/`` beside ``genes/`` or ``star/``; the empty path when there is none."""
    parts = F.split("path", "/")
    folders = paths.select(parts.alias("p")).select(
        "p", F.explode(F.sequence(F.lit(1), F.greatest(F.size("p") - 1, F.lit(1)))).alias("i")
    ).filter(F.col("i") < F.size("p"))
    named = folders.select(F.slice("p", F.lit(1), F.col("i") - 1).alias("parent"), F.element_at("p", F.col("i")).alias("name"))
    sides = named.filter(F.col("name").isin("genes", "star")).select("parent").distinct()
    both = named.filter("name = 'fasta'").select("parent").distinct().join(sides, "parent", "left_semi")
    return both.agg(F.coalesce(F.array_join(F.min("parent"), "/"), F.lit("")).alias("reference_dir"))
