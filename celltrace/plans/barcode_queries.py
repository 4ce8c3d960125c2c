"""Queries on barcode assignment and barcode sharing."""

from __future__ import annotations

from pyspark.sql import functions as F

from celltrace.functions import scalars
from celltrace.operators import barcodes, sharing
from celltrace.plans.proxies import TARGETS, Tables
from celltrace.plans.registry import long, query, rounded
from celltrace.session import cut

CELLS = """
cells AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS sample,
         'c' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '-' || CAST(o_orderkey % 3 AS VARCHAR) AS cell,
         CASE WHEN o_custkey % 13 = 0 THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'Doublets'
              WHEN c_mktsegment = 'HOUSEHOLD' THEN 'HSPC' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Endothelial cells'
              WHEN c_mktsegment = 'BUILDING' THEN 'Mesenchymal type' ELSE c_mktsegment END AS cell_type
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
MAP = """
sample_mouse AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS sample, 'Mouse#' || n_regionkey AS mouse FROM nation WHERE n_regionkey <> 4)"""
KEYS = """
keys AS (
  SELECT p_partkey, p_brand, p_size, upper(p_brand || '_' || p_type || '_' || (p_size % 10)) AS k FROM part)"""
LIBRARY = """
library AS (
  SELECT arg_min(k, p_partkey) AS barcode,
         CAST(arg_min(CASE WHEN p_size % 7 = 0 THEN 2 ELSE p_size END, p_partkey) AS INTEGER) AS mincut
  FROM keys WHERE p_brand <> 'Brand#7' GROUP BY k)"""
RARE = """
rare AS (
  SELECT k AS barcode, sample,
         arg_min(CASE WHEN shifted % 17 = 0 THEN 'bad' ELSE '5e-' || (shifted % 12) END, p_partkey) AS pgen
  FROM (SELECT k, p_partkey, CAST(n_nationkey AS VARCHAR) AS sample, p_partkey + n_nationkey AS shifted FROM keys, nation)
  WHERE shifted % 11 <> 0 GROUP BY k, sample)"""
ASSEMBLIES = """
assemblies AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS sample, 'C' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS cb, k AS polylox
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN keys ON l_partkey = p_partkey)"""
BASE = """
based AS (
  SELECT a.sample, m.mouse, a.cb, a.polylox, CASE WHEN l.barcode IS NULL THEN 1e-8 ELSE 1.0 END AS pgen,
         CASE WHEN l.barcode IS NULL THEN 2 ELSE l.mincut END AS mincut
  FROM assemblies a JOIN sample_mouse m ON a.sample = m.sample LEFT JOIN library l ON a.polylox = l.barcode)"""
CANDIDATES = """
candidates AS (
  SELECT b.sample, b.mouse, b.cb, b.polylox, b.mincut,
         CASE WHEN r.pgen IS NOT NULL THEN TRY_CAST(r.pgen AS DOUBLE) ELSE b.pgen END AS pgen
  FROM based b LEFT JOIN rare r ON r.sample = b.sample AND r.barcode = b.polylox)"""
BEST = """
best AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY sample, mouse, cb
                                 ORDER BY pgen DESC NULLS LAST, mincut ASC NULLS LAST, polylox) AS rn FROM candidates)
  WHERE rn = 1)"""
ASSIGNED = """
assigned AS (
  SELECT c.sample, c.cell, c.cell_type, c.mouse, c.cb, b.polylox, b.pgen, b.mincut,
         reverse(translate(upper(b.polylox), 'ACGTN', 'TGCAN')) AS barcode
  FROM (SELECT x.*, coalesce(m.mouse, 'NoAssign') AS mouse, upper(trim(substr(split_part(cell, '-', 1), 1, 16))) AS cb
        FROM cells x LEFT JOIN sample_mouse m ON x.sample = m.sample) c
  LEFT JOIN best b ON b.sample = c.sample AND b.mouse = c.mouse AND b.cb = c.cb)"""
TRUE_TABLE = """
tbl AS (
  SELECT barcode, cell_type, count(*) AS n FROM assigned
  WHERE pgen < 1e-6 AND barcode IS NOT NULL AND cell_type IS NOT NULL GROUP BY barcode, cell_type)"""

UP_TO_LIBRARY = KEYS + "," + LIBRARY
UP_TO_CANDIDATES = ",".join([MAP, KEYS, LIBRARY, RARE, ASSEMBLIES, BASE, CANDIDATES])
UP_TO_ASSIGNED = ",".join([CELLS, UP_TO_CANDIDATES, BEST, ASSIGNED])
UP_TO_TABLE = UP_TO_ASSIGNED + "," + TRUE_TABLE

LOG_PGEN = "round(log10(pgen), 6) + 0.0 AS log_pgen"


def log_pgen():
    return rounded(F.log10("pgen")).alias("log_pgen")


@query(
    "barcode_assign",
    f"WITH {UP_TO_ASSIGNED} SELECT sample, cell, mouse, cb, polylox, {LOG_PGEN}, CAST(mincut AS BIGINT) AS mincut, barcode FROM assigned",
)
def _(t: Tables):
    return t.assigned.select("sample", "cell", "mouse", "cb", "polylox", log_pgen(), long("mincut").alias("mincut"), "barcode")


@query(
    "assignment_report",
    f"""WITH {UP_TO_ASSIGNED} SELECT count(*) AS n_total, count(polylox) AS n_matched, count(*) - count(polylox) AS n_unmatched,
        round(100.0 * count(polylox) / count(*), 6) AS pct_matched FROM assigned""",
)
def _(t: Tables):
    r = barcodes.assignment_report(t.assigned)
    return r.withColumn("pct_matched", rounded("pct_matched"))


@query(
    "best_barcode_per_cell",
    f"WITH {UP_TO_CANDIDATES}, {BEST} SELECT sample, mouse, cb, polylox, {LOG_PGEN}, CAST(mincut AS BIGINT) AS mincut FROM best",
)
def _(t: Tables):
    best = barcodes.best_barcode_per_cell(t.candidates, "polylox")
    return best.select("sample", "mouse", "cb", "polylox", log_pgen(), long("mincut").alias("mincut"))


@query("barcode_library", f"WITH {UP_TO_LIBRARY} SELECT barcode, CAST(mincut AS BIGINT) AS mincut FROM library")
def _(t: Tables):
    return t.library.select("barcode", long("mincut").alias("mincut"))


@query(
    "library_first",
    f"WITH {KEYS} SELECT k AS barcode, min(p_partkey) AS line_no FROM keys WHERE p_brand <> 'Brand#7' GROUP BY k",
)
def _(t: Tables):
    return barcodes.library_first(t.library_lines).select("barcode", "line_no")


@query(
    "assembly_library_join",
    f"""WITH {MAP}, {UP_TO_LIBRARY}, {ASSEMBLIES}, {BASE}
        SELECT DISTINCT sample, mouse, cb, polylox, {LOG_PGEN}, CAST(mincut AS BIGINT) AS mincut FROM based""",
)
def _(t: Tables):
    rows = barcodes.normalized_assemblies(t.assemblies).join(t.sample_mouse, "sample").distinct()
    joined = barcodes.assembly_library_join(rows, t.library)
    return joined.select("sample", "mouse", "cb", "polylox", log_pgen(), long("mincut").alias("mincut"))


@query(
    "pgen_override",
    f"""WITH {UP_TO_CANDIDATES}
        SELECT DISTINCT sample, mouse, cb, polylox, {LOG_PGEN}, CAST(mincut AS BIGINT) AS mincut FROM candidates""",
)
def _(t: Tables):
    rows = barcodes.normalized_assemblies(t.assemblies).join(t.sample_mouse, "sample").distinct()
    scored = barcodes.pgen_override(barcodes.assembly_library_join(rows, t.library), t.rare)
    return scored.select("sample", "mouse", "cb", "polylox", log_pgen(), long("mincut").alias("mincut"))


@query("rare_pgen_long", f"WITH {KEYS}, {RARE} SELECT barcode, sample, round(log10(TRY_CAST(pgen AS DOUBLE)), 6) + 0.0 AS log_pgen FROM rare")
def _(t: Tables):
    return t.rare.select("barcode", "sample", log_pgen())


@query(
    "rare_key_column",
    "SELECT 'Barcode' AS key_column, count(*) AS n_lines, count(DISTINCT upper(p_brand || '_' || p_type || '_' || (p_size % 10))) AS n_keys FROM part",
)
def _(t: Tables):
    key = barcodes.rare_key_column(t.rare_wide)
    return t.rare_wide.agg(
        F.lit(key).alias("key_column"),
        F.count(key).alias("n_lines"),
        F.count_distinct(scalars.normal_key(key)).alias("n_keys"),
    )


@query(
    "requested_samples",
    """SELECT CAST(c_nationkey AS VARCHAR) AS sample,
              any_value(CASE WHEN n_regionkey <> 4 THEN 'Mouse#' || n_regionkey END) AS mouse,
              any_value(n_regionkey <> 4) AS used
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_nationkey""",
)
def _(t: Tables):
    return barcodes.requested_samples(t.read("customer").select(F.col("c_nationkey").cast("string").alias("sample")), t.sample_mouse)


@query(
    "sample_mouse",
    f"WITH {CELLS}, {MAP} SELECT c.sample, cell, coalesce(mouse, 'NoAssign') AS mouse FROM cells c LEFT JOIN sample_mouse m ON c.sample = m.sample",
)
def _(t: Tables):
    return barcodes.add_mouse(t.cells, t.sample_mouse).select("sample", "cell", "mouse")


@query("unmapped_samples", f"WITH {CELLS}, {MAP} SELECT DISTINCT sample FROM cells WHERE sample NOT IN (SELECT sample FROM sample_mouse)")
def _(t: Tables):
    return barcodes.unmapped_samples(t.cells, t.sample_mouse)


@query(
    "cell_barcode",
    f"WITH {CELLS} SELECT sample, cell, upper(trim(substr(split_part(cell, '-', 1), 1, 16))) AS cb FROM cells",
)
def _(t: Tables):
    return t.cells.select("sample", "cell", scalars.cell_barcode("cell").alias("cb"))


@query(
    "reverse_complement",
    f"WITH {KEYS} SELECT p_partkey, k, reverse(translate(upper(k), 'ACGTN', 'TGCAN')) AS barcode FROM keys",
)
def _(t: Tables):
    key = F.upper(t.barcode_text())
    return t.read("part").select("p_partkey", key.alias("k"), scalars.reverse_complement(F.lower(key)).alias("barcode"))


@query(
    "true_barcode_label",
    f"""WITH {UP_TO_ASSIGNED} SELECT sample, cell, barcode,
        CASE WHEN pgen < 1e-6 THEN 'True barcodes' ELSE 'Not True barcodes' END AS true_bc FROM assigned""",
)
def _(t: Tables):
    return sharing.label_true_barcodes(t.assigned).select("sample", "cell", "barcode", "true_bc")


@query(
    "drop_doublet_type",
    f"WITH {CELLS} SELECT sample, cell, cell_type FROM cells WHERE cell_type IS DISTINCT FROM 'Doublets'",
)
def _(t: Tables):
    return t.cells.filter(scalars.not_doublet("cell_type"))


@query(
    "plottable_cells",
    f"""WITH {UP_TO_ASSIGNED} SELECT sample, cell, cell_type, barcode FROM assigned
        WHERE cell_type IS DISTINCT FROM 'Doublets' AND barcode IS NOT NULL AND barcode <> 'nan'""",
)
def _(t: Tables):
    return sharing.plottable_cells(t.assigned).select("sample", "cell", "cell_type", "barcode")


NO_DOUBLETS = "tbl2 AS (SELECT * FROM tbl WHERE cell_type <> 'Doublets')"


@query("barcode_celltype_table", f"WITH {UP_TO_TABLE}, {NO_DOUBLETS} SELECT * FROM tbl2")
def _(t: Tables):
    return sharing.barcode_celltype_table(t.assigned, doublets="drop_rows", strict=True)


@query(
    "barcode_celltype_ordered",
    f"""WITH {UP_TO_TABLE}, {NO_DOUBLETS},
        c AS (SELECT cell_type, count(*) AS n_barcodes, row_number() OVER (ORDER BY count(*) DESC, cell_type) AS col_rank FROM tbl2 GROUP BY cell_type),
        r AS (SELECT barcode, count(*) AS n_cell_types, row_number() OVER (ORDER BY count(*) DESC, barcode) AS row_rank FROM tbl2 GROUP BY barcode)
        SELECT * FROM tbl2 JOIN c USING (cell_type) JOIN r USING (barcode)""",
)
def _(t: Tables):
    return sharing.ordered_table(cut(sharing.barcode_celltype_table(t.assigned, doublets="drop_rows", strict=True)))


@query(
    "presence_counts",
    f"""WITH {UP_TO_TABLE}, {NO_DOUBLETS}
        SELECT cell_type AS name, count(*) AS n_present, 'cell_type' AS axis FROM tbl2 GROUP BY 1
        UNION ALL SELECT barcode, count(*), 'barcode' FROM tbl2 GROUP BY 1""",
)
def _(t: Tables):
    return sharing.presence_counts(cut(sharing.barcode_celltype_table(t.assigned, doublets="drop_rows", strict=True)))


SETS = """
sets AS (SELECT barcode, coalesce(string_agg(cell_type, ', ' ORDER BY cell_type) FILTER (WHERE cell_type <> 'Doublets'), '') AS cell_types,
                count(*) FILTER (WHERE cell_type <> 'Doublets') AS degree FROM tbl GROUP BY barcode)"""


@query(
    "celltype_combinations",
    f"WITH {UP_TO_TABLE}, {SETS} SELECT cell_types, degree, count(*) AS n, row_number() OVER (ORDER BY degree, count(*) DESC, cell_types) AS place FROM sets GROUP BY 1, 2",
)
def _(t: Tables):
    combos = sharing.celltype_combinations(sharing.barcode_celltype_table(t.assigned, present_only=True))
    return combos.select(F.array_join("cell_types", ", ").alias("cell_types"), long("degree").alias("degree"), "n", long("place").alias("place"))


@query(
    "presence_class",
    f"""WITH {UP_TO_TABLE}, f AS (SELECT barcode, bool_or(cell_type = 'Mesenchymal type') AS a, bool_or(cell_type = 'Endothelial cells') AS b FROM tbl GROUP BY barcode)
        SELECT barcode, CASE WHEN a AND b THEN 'both' WHEN a THEN 'only Mesenchymal type' WHEN b THEN 'only Endothelial cells' ELSE 'other' END AS class FROM f""",
)
def _(t: Tables):
    sets = sharing.celltype_sets(sharing.barcode_celltype_table(t.assigned, present_only=True))
    return sets.select("barcode", sharing.presence_class("cell_types").alias("class"))


@query("celltype_barcode_totals", f"WITH {UP_TO_TABLE}, {NO_DOUBLETS} SELECT cell_type, count(DISTINCT barcode) AS n_barcodes FROM tbl2 GROUP BY 1")
def _(t: Tables):
    return sharing.celltype_barcode_totals(sharing.barcode_celltype_table(t.assigned, present_only=True))


def linked_sql(target: str, require_other: bool) -> str:
    other = "HAVING count(*) FILTER (WHERE cell_type <> '{0}') > 0".format(target) if require_other else ""
    return f"""
        WITH {UP_TO_TABLE},
        linked AS (SELECT barcode FROM tbl WHERE barcode IN (SELECT barcode FROM tbl WHERE cell_type = '{target}') GROUP BY barcode {other}),
        grid AS (SELECT t.cell_type, l.barcode, coalesce(x.n, 0) AS n
                 FROM (SELECT DISTINCT cell_type FROM tbl) t CROSS JOIN linked l
                 LEFT JOIN tbl x ON x.cell_type = t.cell_type AND x.barcode = l.barcode),
        r AS (SELECT cell_type, CAST(sum(n) AS BIGINT) AS row_total,
                     row_number() OVER (ORDER BY cell_type <> '{target}', sum(n) DESC, cell_type) AS row_rank FROM grid GROUP BY cell_type),
        c AS (SELECT barcode, CAST(sum(n) AS BIGINT) AS col_total, row_number() OVER (ORDER BY sum(n) DESC, barcode) AS col_rank FROM grid GROUP BY barcode)
        SELECT cell_type, barcode, n, row_total, col_total, row_rank, col_rank, least(n, 7) AS class
        FROM grid JOIN r USING (cell_type) JOIN c USING (barcode)"""


def linked(t: Tables, target: str, require_other: bool):
    out = sharing.linked_barcodes(cut(sharing.barcode_celltype_table(t.assigned)), target, require_other)
    return out.withColumn("class", long("class"))


@query("linked_barcodes_any", linked_sql(TARGETS["hspc"], False))
def _(t: Tables):
    return linked(t, TARGETS["hspc"], False)


@query("linked_barcodes_other", linked_sql(TARGETS["endothelial"], True))
def _(t: Tables):
    return linked(t, TARGETS["endothelial"], True)


@query("linked_barcodes_mesenchymal", linked_sql(TARGETS["mesenchymal"], True))
def _(t: Tables):
    return linked(t, TARGETS["mesenchymal"], True)


LABELLED = """
labelled AS (
  SELECT barcode, CASE WHEN bool_or(coalesce(pgen < 1e-6, FALSE)) THEN 'True barcodes' ELSE 'Not True barcodes' END AS true_bc
  FROM assigned WHERE cell_type IS DISTINCT FROM 'Doublets' AND barcode IS NOT NULL GROUP BY barcode)"""


@query("barcode_any_true", f"WITH {UP_TO_ASSIGNED}, {LABELLED} SELECT * FROM labelled")
def _(t: Tables):
    return sharing.barcode_any_true(sharing.plottable_cells(sharing.label_true_barcodes(t.assigned)))


@query(
    "barcode_list_page",
    f"""WITH {UP_TO_ASSIGNED}, {LABELLED},
        p AS (SELECT *, row_number() OVER (ORDER BY barcode) - 1 AS i, CAST(ceil(count(*) OVER () / 5.0) AS BIGINT) AS h FROM labelled)
        SELECT barcode, true_bc, CAST(i // h AS BIGINT) AS page_col, CAST(i % h AS BIGINT) AS page_row FROM p""",
)
def _(t: Tables):
    return sharing.barcode_list_page(sharing.barcode_any_true(sharing.plottable_cells(sharing.label_true_barcodes(t.assigned))))


@query(
    "count_class",
    f"WITH {UP_TO_TABLE} SELECT barcode, cell_type, n, CAST(CASE WHEN n >= 7 THEN 7 ELSE n END AS BIGINT) AS class FROM tbl",
)
def _(t: Tables):
    return sharing.barcode_celltype_table(t.assigned).withColumn("class", long(scalars.count_class("n")))
