"""Dense per-cell vectors of the variable genes: regress out, scale, principal components.

A vector is one ``array<double>`` per cell in gene order, so the cells x genes
grid is never shuffled as long rows. Models (coefficients, loadings) have a size
set by the genes and are checked before they go to the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltrace.schema import CELL
from celltrace.session import cut, shuffle_width

# A model sent to every executor: at most this many numbers (512 MB).
MODEL_LIMIT = 1 << 26
# Columns up to which components come from a Gram matrix (2 GB in one task); wider rows are sketched.
GRAM_LIMIT = 16_384
# Genes of a dense vector, whose names and coefficients are sent to every executor.
AXIS_LIMIT = 1 << 20
# Numbers in the vectors of a group that one task may hold (128 MB).
ROWS_LIMIT = 1 << 24
_CHUNK = 1 << 21


def check_model(size: int, what: str) -> None:
    if size > MODEL_LIMIT:
        raise ValueError(f"{what} needs {size} numbers, more than {MODEL_LIMIT}; select fewer genes or groups")


# ---- regression -----------------------------------------------------------------------------


def regression_coefficients(matrix: DataFrame, covariates: DataFrame, genes: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Least squares with intercept on two covariates for every gene: ``(gene, b0, b1, b2, spread)``.

    The covariate moments are shared by all genes; per gene only the stored
    values enter the sums, zeros add nothing to them. Residuals have mean 0, and their sample deviation ``spread`` follows from
    the same sums; what is left of a gene that the covariates explain up to rounding counts as 0.
    """
    a, b = names
    shared = covariates.agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg(a).alias("ma"),
        F.avg(b).alias("mb"),
        (F.var_samp(a) * (F.count(F.lit(1)) - 1)).alias("saa"),
        (F.var_samp(b) * (F.count(F.lit(1)) - 1)).alias("sbb"),
        (F.covar_samp(a, b) * (F.count(F.lit(1)) - 1)).alias("sab"),
    )
    one = shared.select(F.struct("*").alias("s")).scalar()
    sums = (
        matrix.join(covariates.select(*CELL, a, b), CELL)
        .groupBy("gene")
        .agg(
            F.sum("x").alias("_y"), F.sum(F.col("x") * F.col("x")).alias("_yy"),
            F.sum(F.col("x") * F.col(a)).alias("_ya"), F.sum(F.col("x") * F.col(b)).alias("_yb"),
        )
    )
    rows = genes.select("gene").join(sums, "gene", "left").fillna(0.0, ["_y", "_yy", "_ya", "_yb"]).withColumn("s", one)
    s = {f: F.col(f"s.{f}") for f in ("n", "ma", "mb", "saa", "sbb", "sab")}
    say = F.col("_ya") - s["ma"] * F.col("_y")
    sby = F.col("_yb") - s["mb"] * F.col("_y")
    det = s["saa"] * s["sbb"] - s["sab"] * s["sab"]
    solvable = det > s["saa"] * s["sbb"] * 1e-12
    b1 = F.when(solvable, F.try_divide(say * s["sbb"] - sby * s["sab"], det)).when(s["saa"] > 0, F.try_divide(say, s["saa"])).otherwise(0.0)
    b2 = F.when(solvable, F.try_divide(sby * s["saa"] - say * s["sab"], det)).when(s["saa"] > 0, 0.0).when(s["sbb"] > 0, F.try_divide(sby, s["sbb"])).otherwise(0.0)
    solved = rows.withColumn("b1", b1).withColumn("b2", b2).withColumn("_say", say).withColumn("_sby", sby)
    whole = F.col("_yy") - F.col("_y") * F.col("_y") / s["n"]
    left = whole - F.col("b1") * F.col("_say") - F.col("b2") * F.col("_sby")
    spread = F.when(left > whole * 1e-12, F.sqrt(F.try_divide(left, s["n"] - 1))).otherwise(0.0)
    return solved.select("gene", ((F.col("_y") / s["n"]) - F.col("b1") * s["ma"] - F.col("b2") * s["mb"]).alias("b0"), "b1", "b2", F.coalesce(spread, F.lit(0.0)).alias("spread"))


def gene_axis(genes: DataFrame) -> list[str]:
    """Sorted gene names, the positions of a dense vector (bounded by ``AXIS_LIMIT``)."""
    names = [r[0] for r in genes.select("gene").distinct().limit(AXIS_LIMIT + 1).collect()]
    if len(names) > AXIS_LIMIT:
        raise ValueError(f"dense vectors are limited to {AXIS_LIMIT} genes; select variable genes first")
    return sorted(names)


def dense_vectors(
    entries: DataFrame, cells: DataFrame, base: np.ndarray, names: list[str], scale: np.ndarray | None = None, max_value: float | None = None
) -> DataFrame:
    """Dense vector of every cell: ``(1, covariates) @ base`` plus its stored entries, then times ``scale`` and clipped to +-``max_value``.

    ``entries(sample, cell, idx, x)`` hold positions in the vector; a cell has at most one entry per
    gene. Base and scale are sized by genes and are checked before they are sent out; vectors are made a bounded number at a time.
    """
    check_model(base.size + (0 if scale is None else scale.size), "dense vector bases")
    shared = entries.sparkSession.sparkContext.broadcast((base, scale))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, scale = shared.value
        width = base.shape[1]
        step = max(1, _CHUNK // max(width, 1))
        for rows in batches:
            for start in range(0, rows.num_rows, step):
                part = rows.slice(start, step)
                design = np.column_stack([np.ones(part.num_rows), *[part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names]])
                dense = design @ base
                counts = pc.fill_null(pc.list_value_length(part.column("idx")), 0).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(part.num_rows), counts)
                idx, val = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("idx", "val"))
                dense[row, idx.astype(int)] += val
                if scale is not None:
                    dense *= scale
                if max_value is not None:
                    np.clip(dense, -max_value, max_value, out=dense)
                ends = pa.array(np.arange(part.num_rows + 1, dtype="int32") * width)
                v = pa.ListArray.from_arrays(ends, pa.array(dense.ravel()))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in CELL], v], names=[*CELL, "v"])

    stored = (
        entries.groupBy(*CELL)
        .agg(F.collect_list(F.struct("idx", "x")).alias("_e"))
        .select(*CELL, F.col("_e.idx").alias("idx"), F.col("_e.x").alias("val"))
    )
    rows = cells.select(*CELL, *names).join(stored, CELL, "left").repartition(shuffle_width(entries.sparkSession), *CELL)
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(emit, ", ".join(f"{c} {types[c]}" for c in CELL) + ", v array<double>")


def _indexed(matrix: DataFrame, axis: list[str]) -> DataFrame:
    index = matrix.sparkSession.createDataFrame([(g, i) for i, g in enumerate(axis)], "gene string, idx int")
    return matrix.join(index, "gene").select(*CELL, "idx", "x")


def densify(matrix: DataFrame, cells: DataFrame, axis: list[str]) -> DataFrame:
    return dense_vectors(_indexed(matrix, axis), cells, np.zeros((1, len(axis))), [])


def regress_out(
    matrix: DataFrame,
    covariates: DataFrame,
    genes: DataFrame,
    names: tuple[str, str] = ("total_counts", "pct_counts_mt"),
    scaled: bool = False,
    max_value: float | None = 10.0,
) -> tuple[DataFrame, list[str]]:
    """Residual vectors of all cells over the given genes, with the gene axis.

    ``scaled`` gives z-scores of the residuals, clipped to +-``max_value``, in the same pass: their deviations are known from the
    regression's own sums (a deviation of 0 counts as 1).
    """
    fit = regression_coefficients(matrix, covariates, genes, names)
    rows = sorted(fit.limit(AXIS_LIMIT + 1).collect())
    if len(rows) > AXIS_LIMIT:
        raise ValueError(f"residuals are limited to {AXIS_LIMIT} genes; select variable genes first")
    axis = [r["gene"] for r in rows]
    base = np.array([[r["b0"], r["b1"], r["b2"]] for r in rows], dtype=float).reshape(-1, 3).T
    spread = np.array([r["spread"] for r in rows], dtype=float)
    scale = 1.0 / np.where(spread > 0, spread, 1.0) if scaled else None
    return dense_vectors(_indexed(matrix, axis), covariates, -base, list(names), scale, max_value if scaled else None), axis


def scaled_entries(
    matrix: DataFrame, covariates: DataFrame, genes: DataFrame, names: tuple[str, str] = ("total_counts", "pct_counts_mt"), max_value: float = 10.0
) -> tuple[DataFrame, np.ndarray]:
    """The z-scores of ``regress_out(scaled=True)`` as rows ``(sample, cell, names..., idx, val)`` and a base of three lines: a cell's vector is
    ``(1, covariates) @ base`` plus its entries.

    Entries are the stored values and those that are clipped, so rows grow with the stored values and not with cells times genes. A position without
    a stored value is looked at only if its gene reaches ``max_value`` within the covariates of the batch.
    """
    fit = regression_coefficients(matrix, covariates, genes, names)
    rows = sorted(fit.limit(AXIS_LIMIT + 1).collect())
    if len(rows) > AXIS_LIMIT:
        raise ValueError(f"residuals are limited to {AXIS_LIMIT} genes; select variable genes first")
    spread = np.array([r["spread"] for r in rows], dtype=float)
    scale = 1.0 / np.where(spread > 0, spread, 1.0)
    base = -np.array([[r["b0"], r["b1"], r["b2"]] for r in rows], dtype=float).reshape(-1, 3).T * scale
    check_model(base.size + scale.size, "dense vector bases")
    shared = matrix.sparkSession.sparkContext.broadcast((base, scale))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, scale = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            design = np.column_stack([np.ones(batch.num_rows), *[batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names]])
            low, high = design.min(axis=0), design.max(axis=0)
            centre, half = (low + high) / 2, (high - low) / 2
            reach = np.flatnonzero(~(np.abs(centre @ base) + half @ np.abs(base) <= max_value * (1 - 1e-9)))
            step = max(1, _CHUNK // max(len(reach), 1))
            for start in range(0, batch.num_rows, step):
                part, given = batch.slice(start, step), design[start : start + step]
                counts = pc.fill_null(pc.list_value_length(part.column("idx")), 0).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(part.num_rows), counts)
                idx, val = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("idx", "val"))
                idx = idx.astype(np.int64)
                plain = np.einsum("ij,ji->i", given[row], base[:, idx])
                val = np.clip(plain + val * scale[idx], -max_value, max_value) - plain
                if len(reach):
                    beyond = given @ base[:, reach]
                    r, c = np.nonzero(np.abs(beyond) > max_value)
                    free = ~np.isin(r * len(scale) + reach[c], row * len(scale) + idx)
                    r, c = r[free], c[free]
                    row, idx = np.concatenate([row, r]), np.concatenate([idx, reach[c]])
                    val = np.concatenate([val, np.clip(beyond[r, c], -max_value, max_value) - beyond[r, c]])
                order = np.lexsort((idx, row))
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=part.num_rows))]).astype("int32"))
                lists = [pa.ListArray.from_arrays(ends, pa.array(a[order])) for a in (idx.astype("int32"), val)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in (*CELL, *names)], *lists], names=[*CELL, *names, "idx", "val"])

    stored = (
        _indexed(matrix, [r["gene"] for r in rows])
        .groupBy(*CELL)
        .agg(F.collect_list(F.struct("idx", "x")).alias("_e"))
        .select(*CELL, F.col("_e.idx").alias("idx"), F.col("_e.x").alias("val"))
    )
    held = covariates.select(*CELL, *names).join(stored, CELL, "left").repartition(shuffle_width(matrix.sparkSession), *CELL)
    types = {f.name: f.dataType.simpleString() for f in held.schema.fields}
    return held.mapInArrow(emit, ", ".join(f"{c} {types[c]}" for c in (*CELL, *names)) + ", idx array<int>, val array<double>"), base


def scaled_scores(matrix: DataFrame, covariates: DataFrame, genes: DataFrame, k: int, names: tuple[str, str] = ("total_counts", "pct_counts_mt"), max_value: float = 10.0) -> DataFrame:
    """``(sample, cell, v)``: scores of the ``k`` leading components of the z-scores of ``regress_out(scaled=True)``. Of more than ``GRAM_LIMIT`` genes
    no dense vector is made."""
    if genes.count() <= GRAM_LIMIT:
        scaled, _ = regress_out(matrix, covariates, genes, names, scaled=True, max_value=max_value)
        return pca(cut(scaled), k)[0]
    from celltrace.operators.sketch import components_of_entries, scores_of_entries

    rows, base = scaled_entries(matrix, covariates, genes, names, max_value)
    rows = cut(rows)
    return scores_of_entries(rows, base, names, cut(components_of_entries(rows, base, names, k)))


def scale_vectors(vectors: DataFrame, max_value: float | None = 10.0, v: str = "v") -> DataFrame:
    """Per-position z-score (sample deviation, 0 counts as 1), clipped to +-``max_value``."""
    moments = vectors.select(Summarizer.metrics("mean", "variance").summary(array_to_vector(v)).alias("m")).select(
        F.struct(
            vector_to_array("m.mean").alias("mean"),
            F.transform(vector_to_array("m.variance"), lambda s: F.when(s > 0, F.sqrt(s)).otherwise(1.0)).alias("std"),
        ).alias("m")
    )
    scaled = vectors.withColumn("_m", moments.scalar())

    def z(x, i):
        value = (x - F.col("_m.mean")[i]) / F.col("_m.std")[i]
        return value if max_value is None else F.greatest(F.least(value, F.lit(float(max_value))), F.lit(-float(max_value)))

    return scaled.withColumn(v, F.transform(v, z)).drop("_m")


def vectors_to_long(vectors: DataFrame, axis: list[str], value: str) -> DataFrame:
    """Long rows of dense vectors; names come from one shared array, not from a join per value."""
    names = vectors.sparkSession.createDataFrame([(list(axis),)], "a array<string>").scalar()
    long = vectors.withColumn("_names", names).select(*CELL, "_names", F.posexplode("v").alias("_i", value))
    return long.select(*CELL, F.get("_names", F.col("_i")).alias("gene"), value)


# ---- principal components -------------------------------------------------------------------


def _partial_grams(group: list[str], v: str):
    """Running sums of x and x xT per group over a partition sorted by group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, gram, total, n = None, None, None, 0

        def flush():
            head = {g: [part] * (len(total) + 1) for g, part in zip(group, key)}
            return pd.DataFrame({**head, "i": np.arange(-1, len(total)), "n": n, "row": [total, *gram]})

        for pdf in batches:
            pieces = pdf.groupby(group, sort=False, dropna=False) if group else [((), pdf)]
            for name, part in pieces:
                name = name if isinstance(name, tuple) else (name,)
                if name != key:
                    if key is not None:
                        yield flush()
                    key, gram, total, n = name, None, None, 0
                x = np.vstack(part[v].to_numpy())
                if gram is None:
                    gram, total = np.zeros((x.shape[1], x.shape[1])), np.zeros(x.shape[1])
                gram += x.T @ x
                total += x.sum(axis=0)
                n += len(x)
        if key is not None:
            yield flush()

    return run


def _sum_rows(keys: list[str]):
    """Adds up arrays of equal key in a partition sorted by key, holding one sum at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, row, n = None, None, 0
        for pdf in batches:
            out = []
            for *now, size, values in pdf[[*keys, "n", "row"]].itertuples(index=False, name=None):
                now = tuple(now)
                if now != key:
                    if key is not None:
                        out.append((*key, n, row))
                    key, row, n = now, np.array(values, dtype=float), int(size)
                else:
                    row += values
                    n += int(size)
            if out:
                yield pd.DataFrame(out, columns=[*keys, "n", "row"])
        if key is not None:
            yield pd.DataFrame([(*key, n, row)], columns=[*keys, "n", "row"])

    return run


def _component_rows(group: list[str], pdf: pd.DataFrame, values: np.ndarray, basis: np.ndarray, mean: np.ndarray, spread: float) -> pd.DataFrame:
    # Sign convention: the largest loading of a component is positive.
    lead = basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])]
    basis = basis * np.where(lead < 0, -1.0, 1.0)
    variance = np.clip(values, 0.0, None)
    return pd.DataFrame(
        {
            **{g: [pdf[g].iloc[0]] * len(values) for g in group},
            "component": np.arange(1, len(values) + 1),
            "variance": variance,
            "ratio": variance / max(spread, 1e-300),
            "loading": list(basis.T),
            "mean": [mean] * len(values),
        }
    )


def _component_count(k: int, cells: int, columns: int) -> int:
    """Components of a group, whichever way they are found: as many as its cells can tell apart, one at least."""
    return max(1, min(k, columns, cells - 1))


def _without_noise(variances: np.ndarray) -> np.ndarray:
    """Variances that are rounding errors of the largest one are zero."""
    return np.where(variances > 1e-12 * max(float(variances.max(initial=0.0)), 1e-300), variances, 0.0)


def _eigen(group: list[str], k: int):
    """Components of one group from its summed Gram rows (genes x genes, not cells)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = np.vstack(pdf.sort_values("i")["row"].to_numpy())
        total, gram, n = rows[0], rows[1:], int(pdf["n"].iloc[0])
        mean = total / n
        cov = (gram - n * np.outer(mean, mean)) / max(n - 1, 1)
        values, basis = np.linalg.eigh(cov)
        pick = np.argsort(values)[::-1][: _component_count(k, n, len(mean))]
        return _component_rows(group, pdf, _without_noise(values[pick]), basis[:, pick], mean, float(np.trace(cov)))

    return run


def _eigen_of_rows(group: list[str], k: int, v: str):
    """Components of a group with few cells from the singular values of its rows."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.vstack(pdf[v].to_numpy())
        mean = x.mean(axis=0)
        x = x - mean
        _, singular, right = np.linalg.svd(x, full_matrices=False)
        count = _component_count(k, *x.shape)
        dof = max(len(x) - 1, 1)
        return _component_rows(group, pdf, _without_noise(singular[:count] ** 2 / dof), right[:count].T, mean, float((x * x).sum()) / dof)

    return run


def pca_fit(vectors: DataFrame, k: int = 50, group: list[str] | None = None, v: str = "v") -> DataFrame:
    """Principal components per group, one row per component.

    Large groups: every sort partition adds its cells into one Gram matrix and a
    streaming pass sums the Gram rows, so no task holds the cells of a group; the eigenvalue step
    sees genes x genes numbers only. Groups whose cells fit ``ROWS_LIMIT`` numbers, and have
    fewer cells than genes, are decomposed directly. Both ways give ``min(k, columns, cells - 1)`` components, one at least.
    Rows of more than ``GRAM_LIMIT`` columns, without groups, go through ``sketch.sketched_components``.
    """
    group = group or []
    sizes = vectors.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.max(F.size(v)).alias("_d"))
    if (sizes.agg(F.max("_d")).first()[0] or 0) > GRAM_LIMIT:
        if group:
            raise ValueError(f"components of groups are limited to {GRAM_LIMIT} columns")
        from celltrace.operators.sketch import sketched_components

        return sketched_components(vectors, k, v).drop("residual")
    small = (F.col("_n") < F.col("_d")) & (F.col("_n") * F.col("_d") <= ROWS_LIMIT)
    types = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    head = "".join(f"{g} {types[g]}, " for g in group)
    schema = head + "component int, variance double, ratio double, loading array<double>, mean array<double>"
    few, many = sizes.filter(small), sizes.filter(~small)
    if group:
        few_rows = vectors.join(few.select(*group), group, "left_semi").select(*group, v)
        rows = vectors.join(many.select(*group), group, "left_semi").select(*group, v).sortWithinPartitions(*group)
    else:
        is_small = few.count() > 0
        rows, few_rows = (vectors.select(v).limit(0), vectors.select(v)) if is_small else (vectors.select(v), vectors.select(v).limit(0))
    by = group or [F.lit("all").alias("_all")]
    width = shuffle_width(vectors.sparkSession)
    if group:
        few_rows = few_rows.repartition(width, *group)
    partial = rows.mapInPandas(_partial_grams(group, v), head + "i int, n long, row array<double>")
    keys = [*group, "i"]
    summed = (
        partial.repartition(width, *keys).sortWithinPartitions(*keys).mapInPandas(_sum_rows(keys), head + "i int, n long, row array<double>")
    )
    large = summed.groupBy(*by).applyInPandas(_eigen(group, k), schema)
    return large.unionByName(few_rows.groupBy(*by).applyInPandas(_eigen_of_rows(group, k, v), schema))


def pca_project(vectors: DataFrame, model: DataFrame, group: list[str] | None = None, v: str = "v") -> DataFrame:
    """Replace every vector by its component scores (centred before the projection)."""
    group = group or []
    shape = model.agg(F.sum(F.size("loading")).alias("n")).first()["n"] or 0
    check_model(shape, "component loadings")
    fitted: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    rows = model.orderBy(*group, "component").collect()
    for row in rows:
        key = tuple(row[g] for g in group)
        fitted.setdefault(key, ([], row["mean"]))[0].append(row["loading"])
    fitted = {key: (np.array(loading).T, np.array(mean)) for key, (loading, mean) in fitted.items()}
    shared = vectors.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pieces = pdf.groupby(group, sort=False, dropna=False) if group else [((), pdf)]
            for name, part in pieces:
                name = name if isinstance(name, tuple) else (name,)
                basis, mean = shared.value[name]
                step = max(1, _CHUNK // len(mean))
                scores = [
                    (np.vstack(part[v].iloc[s : s + step].to_numpy()) - mean) @ basis for s in range(0, len(part), step)
                ]
                yield part.assign(**{v: list(np.vstack(scores))})

    return vectors.mapInPandas(run, vectors.schema)


# ---- components of many groups from sparse rows ----------------------------------------------


def beside(rows: DataFrame, models: DataFrame, keys: list[str], parts: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(rows, models)`` (Arrow tables) for the rows of every group, cogrouped with the group's models.

    ``parts(keys..., _parts)`` says into how many parts, by the hash of the cell, the rows of a group are dealt; each gets the models of
    its group only. So nothing goes through the driver, a task holds one group's models, and a large group is spread.
    """
    split = [*keys, "_part"]
    dealt = rows.join(parts, keys).withColumn("_part", F.pmod(F.xxhash64(*CELL), F.col("_parts")))
    copies = models.join(parts, keys).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)))
    left = dealt.drop("_parts").repartition(shuffle_width(rows.sparkSession), *split).groupBy(*split)
    right = copies.drop("_parts").groupBy(*split)
    return left.cogroup(right).applyInArrow(fn, schema)


def parts_of(rows: DataFrame, keys: list[str], widths: DataFrame, numbers: int = ROWS_LIMIT) -> DataFrame:
    """``(keys..., _parts)``: parts of a group that hold about ``numbers`` numbers each; ``widths(keys..., _d)`` are those of a row."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).join(widths, keys)
    return sizes.select(*keys, F.greatest(F.ceil(F.col("_n") * F.col("_d") / numbers), F.lit(1)).alias("_parts"))


def _filled(rows: pa.Table, base: np.ndarray) -> np.ndarray:
    """Dense rows: ``base`` plus the stored entries ``idx`` and ``val``."""
    rows = rows.combine_chunks()
    dense = np.repeat(base[None, :], rows.num_rows, axis=0)
    idx, val = (rows.column(c).combine_chunks() for c in ("idx", "val"))
    if isinstance(idx, pa.ChunkedArray):  # no rows
        return dense
    counts = pc.fill_null(pc.list_value_length(idx), 0).to_numpy(zero_copy_only=False)
    place = np.repeat(np.arange(rows.num_rows), counts)
    dense[place, idx.flatten().to_numpy(zero_copy_only=False).astype(int)] += val.flatten().to_numpy(zero_copy_only=False)
    return dense


def _alike(x: np.ndarray, basis: np.ndarray, rows: int = 64) -> np.ndarray:
    """``x @ basis`` in full blocks of rows, as the last rows of a product are rounded in another way: equal rows, which a simulated doublet of one
    cell has, stay equal points wherever they lie."""
    n = len(x)
    return (np.concatenate([x, np.zeros((-n % rows, x.shape[1]))]) @ basis)[:n]


def _runs(counts: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, lines, first entries)`` of the lines of each length, none of them empty; entries lie line by line, ``counts`` of each."""
    starts, order = np.cumsum(counts) - counts, np.argsort(counts, kind="stable")
    lengths, first = np.unique(counts[order], return_index=True)
    groups = np.split(order, first[1:])
    return [(int(n), lines, starts[lines]) for n, lines in zip(lengths, groups) if n]


class _Sparse:
    """Rows of stored entries less their mean, which no dense matrix is made of: what all rows share cancels."""

    def __init__(self, rows: pa.Table, width: int):
        rows = rows.combine_chunks()
        lists = [rows.column(c).combine_chunks() for c in ("idx", "val")]
        counts = pc.fill_null(pc.list_value_length(lists[0]), 0).to_numpy(zero_copy_only=False)
        idx, self.val = (c.flatten().to_numpy(zero_copy_only=False) for c in lists)
        self.idx, self.row, self.shape = idx.astype(np.int64), np.repeat(np.arange(rows.num_rows), counts), (rows.num_rows, width)
        turn = np.argsort(self.idx, kind="stable")
        self.turned = self.row[turn], self.val[turn]
        self.runs, self.turned_runs = _runs(counts), _runs(np.bincount(self.idx, minlength=width))
        self.mean = np.bincount(self.idx, self.val, width) / max(rows.num_rows, 1)

    def product(self, runs: list, at: np.ndarray, val: np.ndarray, block: np.ndarray, lines: int) -> np.ndarray:
        """Sums of ``val * block[at]`` by line, some entries at a time: lines of equal length are one stack of small matrix products."""
        out, room = np.zeros((lines, block.shape[1])), max(1, _CHUNK // 4 // block.shape[1])
        for length, places, starts in runs:
            step = max(1, room // length)
            for s in range(0, len(places), step):
                for a in range(0, length, room):
                    held = starts[s : s + step, None] + np.arange(a, min(length, a + room))
                    out[places[s : s + step]] += np.matmul(val[held][:, None, :], block[at[held]])[:, 0]
        return out

    def entries_times(self, block: np.ndarray) -> np.ndarray:
        return self.product(self.runs, self.idx, self.val, block, self.shape[0])

    def times(self, block: np.ndarray) -> np.ndarray:
        return self.entries_times(block) - self.mean @ block

    def transposed_times(self, block: np.ndarray) -> np.ndarray:
        there = self.product(self.turned_runs, *self.turned, block, self.shape[1])
        return there - np.outer(self.mean, block.sum(axis=0))

    def squares(self) -> float:
        return float((self.val * self.val).sum() - self.shape[0] * (self.mean * self.mean).sum())


def _leading(x: _Sparse, count: int, tolerance: float = 1e-10) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` greatest eigenvalues of ``x.T @ x`` and their vectors: block Lanczos on the rows' products, made orthogonal to all earlier
    blocks and begun again from the best vectors when ``_basis_columns`` are full, until the residuals are below ``tolerance`` of the greatest one."""
    n = x.shape[0]
    size = min(n, count + 10)
    most = min(n, max(3 * size, _basis_columns(n)))
    block = np.linalg.qr(np.random.default_rng(0).standard_normal((n, size)))[0]
    basis, image, inner, due = np.empty((n, 0)), np.empty((n, 0)), np.empty((0, 0)), 0
    while True:
        fresh = x.times(x.transposed_times(block))
        basis, image = np.hstack([basis, block]), np.hstack([image, fresh])
        met, old = basis.T @ fresh, len(inner)
        inner = np.block([[inner, met[:old]], [met[:old].T, (met[old:] + met[old:].T) / 2]])
        full = basis.shape[1] + size > most
        if full or basis.shape[1] >= min(due, n):  # the products inside the basis cost its cube, so they are looked at whenever it has grown by a fourth
            due = basis.shape[1] * 5 // 4
            values, inside = np.linalg.eigh(inner)
            values, inside = values[::-1][:size], inside[:, ::-1][:, :size]
            ritz, pulled = basis @ inside, image @ inside
            left = pulled - ritz * values
        else:
            left = None
        if left is not None and (basis.shape[1] >= n or np.linalg.norm(left[:, :count], axis=0).max() <= tolerance * max(values[0], 1e-300)):
            values, vectors = _without_noise(np.clip(values[:count], 0.0, None)), x.transposed_times(ritz[:, :count])
            lengths = np.linalg.norm(vectors, axis=0)
            return values, np.where(values > 0, vectors / np.where(lengths > 0, lengths, 1.0), 0.0)
        if full and basis.shape[1] > 2 * size:
            basis, image, fresh, inner, due = ritz, pulled, left, np.diag(values), 0
        for _ in range(2):
            fresh = fresh - basis @ (basis.T @ fresh)
        lengths = np.linalg.norm(fresh, axis=0)
        fresh = np.where(lengths > 1e-13 * max(values[0], 1e-300), fresh / np.where(lengths > 0, lengths, 1.0), np.random.default_rng(basis.shape[1]).standard_normal(fresh.shape))
        fresh = fresh[:, : n - basis.shape[1]]
        for _ in range(2):
            fresh = np.linalg.qr(fresh - basis @ (basis.T @ fresh))[0]
        block = fresh


def _basis_columns(n: int) -> int:
    """Vectors of the search for ``n`` rows that are held at once (256 MB with their products)."""
    return ROWS_LIMIT // max(n, 1)


def _key_values(table: pa.Table, keys: list[str]) -> dict:
    return {k: table.column(k)[0].as_py() for k in keys}


def _model_table(group: dict, kinds: pa.Schema, values: np.ndarray, basis: np.ndarray, start: np.ndarray, spread: float) -> pa.Table:
    """Component 0 with ``start`` as its loading, then the components."""
    found = _component_rows([], pd.DataFrame(), _without_noise(values), basis, start, spread)
    n = len(found) + 1
    columns = {c: [v] * n for c, v in group.items()}
    columns |= {"component": range(n), "variance": [0.0, *found["variance"]], "ratio": [0.0, *found["ratio"]], "loading": [start, *found["loading"]]}
    return pa.table({name: pa.array(list(values), kinds.field(name).type) for name, values in columns.items()})


def _model_schema(base: pa.Table, keys: list[str]) -> pa.Schema:
    kinds = [(c, base.schema.field(c).type) for c in keys]
    return pa.schema([*kinds, ("component", pa.int32()), ("variance", pa.float64()), ("ratio", pa.float64()), ("loading", pa.list_(pa.float64()))])


def sparse_components(rows: DataFrame, bases: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """Principal components per group of the sparse ``rows(keys..., sample, cell, idx, val)`` on top of the group's ``bases(keys..., base)``.

    ``(keys..., component, variance, ratio, loading)``; component 0 is the base less the mean: what an empty row is in front of the
    loadings. A group that fits one task is decomposed there; of a larger one every part adds up a Gram matrix, and these are summed by row.
    A group whose stored entries fit one task, though its dense rows do not, is decomposed there from the entries alone, whatever its columns.
    """
    widths = bases.select(*keys, F.size("base").alias("_d"))
    parts = cut(parts_of(rows, keys, widths))
    types = {f.name: f.dataType.simpleString() for f in bases.schema.fields}
    head = "".join(f"{c} {types[c]}, " for c in keys)
    schema = head + "component int, variance double, ratio double, loading array<double>"

    def whole(cells: pa.Table, base: pa.Table) -> pa.Table:
        kinds = _model_schema(base, keys)
        if not cells.num_rows or not base.num_rows:
            return kinds.empty_table()
        start = np.array(base.column("base")[0].as_py(), float)
        x = _filled(cells, start)
        mean = x.mean(axis=0)
        x -= mean
        count, dof = _component_count(k, *x.shape), max(len(x) - 1, 1)
        wide = x.shape[0] < x.shape[1]
        values, basis = np.linalg.eigh((x @ x.T if wide else x.T @ x) / dof)
        values, basis = values[::-1][:count], basis[:, ::-1][:, :count]
        if wide and values[-1] > 1e-8 * values[0]:
            basis = x.T @ (basis / np.sqrt(values * dof))
        elif wide:  # too close to zero for squares
            _, singular, right = np.linalg.svd(x, full_matrices=False)
            values, basis = singular[:count] ** 2 / dof, right[:count].T
        return _model_table(_key_values(cells, keys), kinds, values, basis, start - mean, float((x * x).sum()) / dof)

    width = shuffle_width(rows.sparkSession)
    one = rows.join(parts.filter("_parts = 1").select(*keys), keys, "left_semi").repartition(width, *keys)
    small = one.groupBy(*keys).cogroup(bases.groupBy(*keys)).applyInArrow(whole, schema)
    many = parts.filter("_parts > 1")

    def entries_only(cells: pa.Table, base: pa.Table) -> pa.Table:
        kinds = _model_schema(base, keys)
        if not cells.num_rows or not base.num_rows:
            return kinds.empty_table()
        start = np.array(base.column("base")[0].as_py(), float)
        x = _Sparse(cells, len(start))
        dof = max(x.shape[0] - 1, 1)
        values, basis = _leading(x, _component_count(k, *x.shape))
        return _model_table(_key_values(cells, keys), kinds, values / dof, basis, -x.mean, x.squares() / dof)

    held = rows.join(many.select(*keys), keys, "left_semi").groupBy(*keys).agg(F.sum(F.greatest(F.coalesce(F.size("idx"), F.lit(0)), F.lit(0))).alias("_stored"), F.count(F.lit(1)).alias("_n"))
    # the entries, the block in front of the columns and the vectors of the search
    fitting = held.join(widths, keys).filter((F.col("_stored") <= ROWS_LIMIT) & (F.col("_d") * (k + 10) <= MODEL_LIMIT) & (F.col("_n") * (k + 10) * 3 <= ROWS_LIMIT * 2))
    fitting = cut(fitting.select(*keys))
    if not fitting.isEmpty():
        alone = rows.join(fitting, keys, "left_semi").repartition(width, *keys)
        small = small.unionByName(alone.groupBy(*keys).cogroup(bases.groupBy(*keys)).applyInArrow(entries_only, schema))
        many = many.join(fitting, keys, "left_anti")
    widest = many.join(widths, keys).agg(F.max("_d")).first()[0]
    if widest is None:
        return small
    if widest > GRAM_LIMIT:
        raise ValueError(f"principal components are limited to {GRAM_LIMIT} columns")

    def grams(cells: pa.Table, base: pa.Table) -> pa.Table:
        if not cells.num_rows or not base.num_rows:
            return pa.schema([*((c, base.schema.field(c).type) for c in keys), ("i", pa.int32()), ("n", pa.int64()), ("row", pa.list_(pa.float64()))]).empty_table()
        x = _filled(cells, np.array(base.column("base")[0].as_py(), float))
        lines = [x.sum(axis=0), *(x.T @ x)]
        columns = {c: pa.array([v] * len(lines), base.schema.field(c).type) for c, v in _key_values(base, keys).items()}
        return pa.table({**columns, "i": pa.array(range(-1, len(lines) - 1), pa.int32()), "n": pa.array([len(x)] * len(lines), pa.int64()), "row": pa.array(lines, pa.list_(pa.float64()))})

    def eigen(lines: pa.Table, base: pa.Table) -> pa.Table:
        kinds = _model_schema(base, keys)
        if not lines.num_rows:
            return kinds.empty_table()
        start, order = np.array(base.column("base")[0].as_py(), float), np.argsort(lines.column("i").to_numpy())
        sums = np.asarray(lines.column("row").combine_chunks().flatten()).reshape(lines.num_rows, -1)[order]
        n, mean = lines.column("n")[0].as_py(), sums[0] / lines.column("n")[0].as_py()
        cov = (sums[1:] - n * np.outer(mean, mean)) / max(n - 1, 1)
        values, basis = np.linalg.eigh(cov)
        count = _component_count(k, n, len(mean))
        return _model_table(_key_values(lines, keys), kinds, values[::-1][:count], basis[:, ::-1][:, :count], start - mean, float(np.trace(cov)))

    by = [*keys, "i"]
    sums = head + "i int, n long, row array<double>"
    partial = beside(rows, bases, keys, many, grams, sums)
    summed = partial.repartition(width, *by).sortWithinPartitions(*by).mapInPandas(_sum_rows(by), sums)
    return small.unionByName(summed.groupBy(*keys).cogroup(bases.groupBy(*keys)).applyInArrow(eigen, schema))


def sparse_scores(rows: DataFrame, model: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with component scores ``v`` in place of ``idx`` and ``val``; ``model`` as ``sparse_components`` gives it."""
    # what a row brings to its task: its entries and its scores; only a part that is small even as dense rows is multiplied as such
    room = ROWS_LIMIT
    heights = model.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    stored = rows.groupBy(*keys).agg(F.avg(F.greatest(F.coalesce(F.size("idx"), F.lit(0)), F.lit(0))).alias("_e"))
    parts = cut(parts_of(rows, keys, stored.join(heights, keys).select(*keys, (F.col("_e") + F.col("_c")).alias("_d"))))
    kept = [c for c in rows.columns if c not in ("idx", "val")]
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in kept) + ", v array<double>"

    def run(cells: pa.Table, fitted: pa.Table) -> pa.Table:
        lists = fitted.column("loading").combine_chunks()
        order = np.argsort(fitted.column("component").to_numpy())
        lines = [np.asarray(lists[int(i)].values, float) for i in order]
        n = cells.num_rows if lines else 0
        basis = np.array(lines[1:]).T
        flat = np.empty((0, 1))
        if n and n * len(lines[0]) <= room:
            step = max(1, _CHUNK // max(len(lines[0]), 1))
            flat = np.concatenate([_alike(_filled(cells.slice(s, step), lines[0]), basis) for s in range(0, n, step)])
        elif n:
            x = _Sparse(cells, len(lines[0]))
            flat = x.entries_times(basis) + lines[0] @ basis
        ends = pa.array(np.arange(len(flat) + 1, dtype="int32") * flat.shape[1])
        v = pa.ListArray.from_arrays(ends, pa.array(flat.ravel()))
        return pa.table([*(cells.slice(0, n).column(c) for c in kept), v], names=[*kept, "v"])

    return beside(rows, model, keys, parts, run, schema)


def pca(vectors: DataFrame, k: int = 50, group: list[str] | None = None, v: str = "v") -> tuple[DataFrame, DataFrame]:
    """Scores and model. The model is a few rows and is written once, being used twice."""
    model = cut(pca_fit(vectors, k, group, v))
    return pca_project(vectors, model, group, v), model
