"""Column expressions on one row. All stay inside generated JVM code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label texts, cut-off and file-name patterns that results must carry.
TRUE_LABEL = "True barcodes"
NOT_TRUE_LABEL = "Not True barcodes"
DOUBLET_TYPE = "Doublets"
UNMAPPED_MOUSE = "NoAssign"
TRUE_PGEN_CUTOFF = 1e-6
CLASS_EDGES = [0, 1, 2, 3, 4, 5, 6, 7]
FASTQ_NAME = r"^(.+?)_S\d+_L\d{3}_R[12]_\d{3}\.(?:fastq|fq)\.gz$"
# Texts that a table reader treats as missing.
NA_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# A decimal number as table readers take it; Java's suffixes and hexadecimal forms are bad text.
DECIMAL = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?inf(inity)?$"

# All characters that count as white space.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: Column | str) -> Column:
    """Remove white space of any kind at both ends (plain ``trim`` removes blanks only)."""
    return F.btrim(col(c), F.lit(BLANKS))


def normal_key(c: Column | str) -> Column:
    return F.upper(strip_text(c))


def missing_to_null(c: Column | str) -> Column:
    """Texts that a table reader takes as missing, compared as they stand."""
    c = col(c)
    return F.when(~c.isin(NA_TEXT), c)


def lenient_double(c: Column | str) -> Column:
    """Number, or null for bad text and for NaN."""
    text = strip_text(col(c).cast("string"))
    return F.when(text.rlike(DECIMAL), text.try_cast("double"))


def strict_double(c: Column | str) -> Column:
    """Number, or null for NaN; bad text is an error."""
    return nan_to_null(strip_text(col(c).cast("string")).cast("double"))


def nan_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(~F.isnan(c), c)


def truncated_int(c: Column | str, default: int) -> Column:
    """Lenient number, default for missing, then cut to an integer."""
    return F.coalesce(lenient_double(c), F.lit(float(default))).try_cast("long")


def cell_barcode(c: Column | str, cb_length: int = 16) -> Column:
    """Cell barcode inside a cell name such as ``ACGT...-1``."""
    head = F.split_part(col(c), F.lit("-"), F.lit(1))
    return normal_key(F.substring(head, 1, cb_length))


def reverse_complement(c: Column | str) -> Column:
    return F.reverse(F.translate(F.upper(col(c)), "ACGTN", "TGCAN"))


def true_barcode_label(pgen: Column | str, cutoff: float = TRUE_PGEN_CUTOFF) -> Column:
    return F.when(col(pgen) < F.lit(cutoff), TRUE_LABEL).otherwise(NOT_TRUE_LABEL)


def below_cutoff(pgen: Column | str, cutoff: float = TRUE_PGEN_CUTOFF) -> Column:
    """Strict comparison; null never passes."""
    return F.coalesce(col(pgen) < F.lit(cutoff), F.lit(False))


def barcode_present(c: Column | str) -> Column:
    c = col(c)
    return c.isNotNull() & (c != "nan")


def not_doublet(cell_type: Column | str) -> Column:
    """A missing cell type passes, unlike with a plain ``!=``."""
    return ~col(cell_type).eqNullSafe(F.lit(DOUBLET_TYPE))


def is_mitochondrial(gene: Column | str) -> Column:
    return col(gene).startswith("mt-") | col(gene).startswith("MT-")


def capitalize(c: Column | str) -> Column:
    """First letter upper, all others lower (``initcap`` works per word)."""
    c = col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def joined_names(names: Column | str) -> Column:
    return F.coalesce(F.array_join(col(names), "; "), F.lit(""))


def count_class(n: Column | str) -> Column:
    """Class of a cell count: 0 to 6 by their own, 7 and more together."""
    n = col(n)
    return reduce(
        lambda so_far, edge: F.when(n >= edge, edge).otherwise(so_far), CLASS_EDGES[1:], F.lit(0)
    ).cast("int")


def safe_id(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"[^A-Za-z0-9._-]+", "_")


def fastq_sample(name: Column | str) -> Column:
    """Sample in a read-file name; null where the name does not fit."""
    found = F.regexp_extract(col(name), FASTQ_NAME, 1)
    return F.when(found != "", found)


def finite(c: Column | str) -> Column:
    c = col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def renamed_group(c: Column | str, names: dict[str, str]) -> Column:
    """Look up a few literal names; other values become null."""
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), col(c))
