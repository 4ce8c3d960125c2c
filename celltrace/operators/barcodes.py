"""Lineage-barcode library, candidate assemblies and the choice of one barcode per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltrace.functions.scalars import (
    UNMAPPED_MOUSE,
    cell_barcode,
    lenient_double,
    missing_to_null,
    nan_to_null,
    normal_key,
    reverse_complement,
    truncated_int,
)
from celltrace.operators.ordering import top_per_key

# Result columns of an earlier run, and the known key columns of a rare-pGen file.
STALE_COLUMNS = ["barcode", "pGen", "pgen", "MinCut", "mincut", "polylox", "polylox_new", "Polylox_BC", "MouseBC", "cb"]
RARE_KEYS = ["PolyloxBC", "Barcode", "barcode", "polylox"]
# pGen of a library barcode, pGen of a barcode outside it, default MinCut.
LIBRARY_PGEN = 1.0
MISSING_PGEN = 1e-8
DEFAULT_MINCUT = 2

LOOKUP_KEY = ["sample", "mouse", "cb"]


def drop_stale(obs: DataFrame) -> DataFrame:
    return obs.drop(*STALE_COLUMNS)


def sample_map_first(sample_mouse: DataFrame) -> DataFrame:
    """One mouse per sample; rows with a missing side are dropped, the first line wins."""
    rows = sample_mouse.dropna(subset=["sample", "mouse"])
    if "line_no" not in rows.columns:
        return rows.select("sample", "mouse").distinct()
    return top_per_key(rows, ["sample"], ["line_no"]).select("sample", "mouse")


def add_mouse(obs: DataFrame, sample_mouse: DataFrame) -> DataFrame:
    joined = obs.drop("mouse").join(sample_mouse.select("sample", "mouse"), "sample", "left")
    return joined.withColumn("mouse", F.coalesce("mouse", F.lit(UNMAPPED_MOUSE)))


def unmapped_samples(obs: DataFrame, sample_mouse: DataFrame) -> DataFrame:
    return obs.select("sample").distinct().join(sample_mouse.select("sample"), "sample", "left_anti")


def requested_samples(requested: DataFrame, sample_mouse: DataFrame) -> DataFrame:
    """Requested samples with the map's answer; ``used`` is false for those to skip."""
    known = sample_mouse.select("sample", "mouse").withColumn("_known", F.lit(True))
    return (
        requested.select("sample")
        .distinct()
        .join(known, "sample", "left")
        .select("sample", "mouse", F.coalesce("_known", F.lit(False)).alias("used"))
    )


def library_first(lines: DataFrame, key: str = "barcode") -> DataFrame:
    """First line of every normalised key."""
    keyed = lines.withColumn(key, normal_key(key)).filter(F.col(key).isNotNull())
    return top_per_key(keyed, [key], ["line_no"])


def barcode_library(lines: DataFrame, mincuts: DataFrame, default_mincut: int = DEFAULT_MINCUT) -> DataFrame:
    """Join line *i* of the library with line *i* of the MinCut list, cut to the shorter
    one, then keep the first line of every barcode. Returns ``(barcode, mincut)``."""
    paired = lines.join(mincuts, "line_no").withColumn("mincut", truncated_int("mincut", default_mincut))
    return library_first(paired).select("barcode", "mincut")


def rare_key_column(rare: DataFrame) -> str:
    """First known key column that exists and holds at least one value."""
    present = [c for c in RARE_KEYS if c in rare.columns]
    if present:
        filled = rare.agg(*[F.count(missing_to_null(c)).alias(c) for c in present]).first()
        for name in present:
            if filled[name]:
                return name
    raise ValueError(f"no usable barcode key column; looked for {RARE_KEYS}, found {rare.columns}")


def rare_pgen_long(rare: DataFrame, key: str | None = None) -> DataFrame:
    """Wide rare-pGen table (one column per sample) to ``(barcode, sample, pgen)``, first filled
    line per barcode and sample; pGen is null where that line holds no number.

    The value is parsed first: a number and its line fit a hash aggregate, so each map
    task sends one row per barcode and sample.
    """
    key = key or rare_key_column(rare)
    samples = [c for c in rare.columns if c not in RARE_KEYS and c != "line_no"]
    long = (
        rare.select("line_no", normal_key(key).alias("barcode"), *[F.col(f"`{c}`").cast("string") for c in samples])
        .unpivot(["line_no", "barcode"], samples, "sample", "pgen")
        .filter(missing_to_null("pgen").isNotNull() & F.col("barcode").isNotNull())
    )
    return long.groupBy("barcode", "sample").agg(F.min_by(lenient_double("pgen"), "line_no").alias("pgen"))


def normalized_assemblies(assemblies: DataFrame) -> DataFrame:
    """Keys without blanks and in upper case; a row lacking one can match nothing."""
    rows = assemblies.dropna(subset=["cb", "polylox"])
    return rows.withColumn("cb", normal_key("cb")).withColumn("polylox", normal_key("polylox"))


def assembly_library_join(
    assemblies: DataFrame,
    library: DataFrame,
    missing_pgen: float = MISSING_PGEN,
    default_mincut: int = DEFAULT_MINCUT,
) -> DataFrame:
    """Base pGen and MinCut of every candidate; a barcode outside the library is kept."""
    known = library.select(F.col("barcode").alias("polylox"), F.col("mincut"), F.lit(LIBRARY_PGEN).alias("pgen"))
    return (
        assemblies.join(known, "polylox", "left")
        .withColumn("pgen", F.coalesce("pgen", F.lit(missing_pgen)))
        .withColumn("mincut", F.coalesce("mincut", F.lit(default_mincut)))
    )


def pgen_override(candidates: DataFrame, rare: DataFrame) -> DataFrame:
    """A filled rare value of the same sample replaces the base pGen, also for barcodes outside
    the library. A filled value that is no number leaves pGen missing."""
    value = rare.select("sample", F.col("barcode").alias("polylox"), F.col("pgen").alias("_rare"), F.lit(True).alias("_filled"))
    return (
        candidates.join(value, ["sample", "polylox"], "left")
        .withColumn("pgen", F.when(F.col("_filled"), F.col("_rare")).otherwise(F.col("pgen")))
        .drop("_rare", "_filled")
    )


def best_barcode_per_cell(candidates: DataFrame, order: Column | str = "row_no") -> DataFrame:
    """Highest pGen, then lowest MinCut, then input order; missing values last."""
    ranked = candidates.withColumn("pgen", nan_to_null("pgen"))
    picked = top_per_key(
        ranked,
        LOOKUP_KEY,
        [F.col("pgen").desc_nulls_last(), F.col("mincut").asc_nulls_last(), order],
    )
    return picked.select(*LOOKUP_KEY, "polylox", "pgen", "mincut")


def candidate_barcodes(
    assemblies: DataFrame,
    sample_mouse: DataFrame,
    library: DataFrame,
    rare: DataFrame | None = None,
    missing_pgen: float = MISSING_PGEN,
    default_mincut: int = DEFAULT_MINCUT,
) -> DataFrame:
    """Scored candidates of all mapped samples in one pass. Exact copies are not removed
    here: they cannot change which row is best, and a distinct would cost a shuffle."""
    mapped = normalized_assemblies(assemblies).join(sample_mouse.select("sample", "mouse"), "sample")
    scored = assembly_library_join(mapped, library, missing_pgen, default_mincut)
    return pgen_override(scored, rare) if rare is not None else scored


def assign_barcodes(obs: DataFrame, lookup: DataFrame, use_reverse_complement: bool = True) -> DataFrame:
    """Left join on sample, mouse and cell barcode; every cell stays."""
    joined = obs.join(lookup, LOOKUP_KEY, "left")
    final = reverse_complement("polylox") if use_reverse_complement else F.col("polylox")
    return joined.withColumn("barcode", final)


def barcode_assign(
    obs: DataFrame,
    assemblies: DataFrame,
    sample_mouse: DataFrame,
    library: DataFrame,
    rare: DataFrame | None = None,
    *,
    cb_length: int = 16,
    missing_pgen: float = MISSING_PGEN,
    default_mincut: int = DEFAULT_MINCUT,
    use_reverse_complement: bool = True,
    order: Column | str = "row_no",
) -> DataFrame:
    """Which lineage barcode does each cell carry?"""
    if "sample" not in obs.columns:
        raise ValueError("cells need a 'sample' column")
    cells = add_mouse(drop_stale(obs), sample_mouse).withColumn("cb", cell_barcode("cell", cb_length))
    candidates = candidate_barcodes(assemblies, sample_mouse, library, rare, missing_pgen, default_mincut)
    return assign_barcodes(cells, best_barcode_per_cell(candidates, order), use_reverse_complement)


def assignment_report(assigned: DataFrame) -> DataFrame:
    return assigned.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count("polylox").alias("n_matched"),
        (F.count(F.lit(1)) - F.count("polylox")).alias("n_unmatched"),
        F.coalesce(F.try_divide(F.count("polylox") * 100.0, F.count(F.lit(1))), F.lit(0.0)).alias("pct_matched"),
    )
