"""Queries on file listings and matrix text, with paths and lines derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from celltrace.operators.ordering import rank_in_group
from celltrace.plans.count_queries import COUNTS
from celltrace.plans.proxies import Tables, text
from celltrace.plans.registry import query
from celltrace.session import cut
from celltrace.sources import files

PARTS = """
u AS (SELECT page_id, split_part(regexp_replace(url, '^https?://', ''), '/', 1) AS host, split_part(regexp_replace(url, '^https?://', ''), '/', 2) AS lang FROM pages)"""
FASTQ = """
f AS (SELECT CASE WHEN page_id % 10 = 0 THEN 'scripts/' ELSE '' END || host AS dir, lang || ' smp' AS sample, page_id % 5 = 0 AS is_index, page_id % 10 = 0 AS excluded FROM u),
s AS (SELECT sample, string_agg(DISTINCT '/data/' || dir, ',' ORDER BY '/data/' || dir) AS dirs FROM f WHERE NOT is_index AND NOT excluded GROUP BY sample)"""


def url_parts(t: Tables):
    rest = F.regexp_replace("url", "^https?://", "")
    return t.read("pages").select(
        "page_id", F.split_part(rest, F.lit("/"), F.lit(1)).alias("host"), F.split_part(rest, F.lit("/"), F.lit(2)).alias("lang")
    )


def fastq_paths(t: Tables):
    top = F.when(F.col("page_id") % 10 == 0, "scripts/").otherwise("")
    read = F.when(F.col("page_id") % 5 == 0, "I1").otherwise("R1")
    name = F.concat("lang", F.lit(" smp_S"), text(F.col("page_id") % 4), F.lit("_L001_"), read, F.lit("_001.fastq.gz"))
    return url_parts(t).select(F.concat(top, "host", F.lit("/"), name).alias("path"))


@query("fastq_samples", f"WITH {PARTS}, {FASTQ} SELECT sample, dirs FROM s")
def _(t: Tables):
    return files.fastq_samples(fastq_paths(t), "/data").select("sample", F.array_join("dirs", ",").alias("dirs"))


@query(
    "job_manifest",
    f"""WITH {PARTS}, {FASTQ}, r AS (SELECT *, regexp_replace(sample, '[^A-Za-z0-9._-]+', '_', 'g') AS run_id FROM s)
        SELECT sample, run_id, dirs AS fastq_dirs,
               'cellranger count --id="' || run_id || '" --transcriptome="/ref" --fastqs="' || dirs || '" --sample="' || sample || '" --localcores=16 --localmem=100 --create-bam=true' AS command,
               'bash /data/scripts/cellranger_count_' || run_id || '.sh' AS swarm_line FROM r""",
)
def _(t: Tables):
    return files.job_manifest(files.fastq_samples(fastq_paths(t), "/data"), "/data", "/ref")


@query(
    "discover_samples",
    f"""WITH {PARTS} SELECT host AS sample, CASE WHEN bool_or(lang = 'en') THEN host || '/filtered_feature_bc_matrix' END AS matrix_dir, bool_or(lang = 'en') AS found,
        row_number() OVER (ORDER BY host) AS place FROM u GROUP BY host""",
)
def _(t: Tables):
    folder = F.when(F.col("lang") == "en", files.MATRIX_DIR).otherwise("raw")
    return files.discover_samples(url_parts(t).select(F.concat_ws("/", "host", folder, F.lit("matrix.mtx.gz")).alias("path")))


@query(
    "pick_reference_dir",
    f"""WITH {PARTS}, d AS (SELECT host || '/' || lang AS parent, bool_or(page_id % 3 = 0) AS a, bool_or(page_id % 3 <> 0) AS b FROM u GROUP BY 1)
        SELECT coalesce(string_agg(parent, ''), '') AS reference_dir FROM (SELECT parent FROM d WHERE a AND b ORDER BY string_split(parent, '/') LIMIT 1)""",
)
def _(t: Tables):
    kind = F.when(F.col("page_id") % 3 == 0, "fasta").when(F.col("page_id") % 3 == 1, "genes").otherwise("star")
    return files.pick_reference_dir(url_parts(t).select(F.concat_ws("/", "host", "lang", kind, F.lit("data.bin")).alias("path")))


@query("read_mtx", f"WITH {COUNTS} SELECT * FROM counts")
def _(t: Tables):
    """Counts written as matrix text lines per sample, then parsed again."""
    t.keep("counts")
    cells = cut(rank_in_group(t.counts.select("sample", "cell").distinct(), ["sample"], ["cell"], "line_no"))
    genes = cut(rank_in_group(t.counts.select("sample", "gene").distinct(), ["sample"], ["gene"], "line_no"))
    entries = (
        t.counts.join(cells.withColumnRenamed("line_no", "c"), ["sample", "cell"]).join(genes.withColumnRenamed("line_no", "g"), ["sample", "gene"])
        .select("sample", F.lit(2).cast("long").alias("line"), F.concat_ws(" ", text("g"), text("c"), text("x")).alias("value"))
    )
    # the last line of a sample's genes and cells is their number
    last = lambda lines, name: lines.groupBy("sample").agg(F.max("line_no").alias(name))
    sizes = (
        t.counts.groupBy("sample").agg(F.count(F.lit(1)).alias("n")).join(last(genes, "g"), "sample").join(last(cells, "c"), "sample")
        .select("sample", F.explode(F.array(
            F.struct(F.lit(0).cast("long").alias("line"), F.lit("%%MatrixMarket matrix coordinate real general").alias("value")),
            F.struct(F.lit(1).cast("long").alias("line"), F.concat_ws(" ", text("g"), text("c"), text("n")).alias("value")),
        )).alias("l"))
        .select("sample", "l.*")
    )
    barcode_lines = cells.select("sample", "line_no", F.col("cell").alias("value"))
    feature_lines = genes.select("sample", "line_no", F.concat_ws("\t", F.concat(F.lit("id"), "gene"), "gene").alias("value"))
    return files.counts_from_lines(entries.unionByName(sizes), barcode_lines, feature_lines)
