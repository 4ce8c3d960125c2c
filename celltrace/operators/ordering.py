"""Ranks, first-per-key, exact quantiles and small value lists that hold under skew.

A plain ``row_number`` over a hot group (or over no group at all) sorts that
group in one task. Here the table is range-sorted once over all executors and a
row's rank is its place inside its sort partition plus the sizes of the
partitions before it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from celltrace.session import cut

_LOCAL_BITS = 33


def global_rank(df: DataFrame, order: list, name: str = "rank", part: str | None = None) -> DataFrame:
    """1-based place of every row in the total order ``order`` (must be unique for a
    repeatable answer). ``part`` names a column that keeps the sort partition."""
    placed = cut(df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_pos", _LOCAL_BITS))
    # One row per sort partition: the running sum is over that short list only.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select(
        "_part",
        (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"),
    )
    local = F.col("_pos").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    out = placed.join(before, "_part").withColumn(name, (F.col("_before") + local + 1).cast("long")).drop("_pos", "_before")
    return out.withColumnRenamed("_part", part) if part else out.drop("_part")


def rank_in_group(df: DataFrame, group: list[str], order: list, name: str = "rank") -> DataFrame:
    """``row_number`` per group, with hot groups spread over many tasks."""
    ranked = global_rank(df, [*group, *order], "_grank")
    starts = ranked.groupBy(*group).agg(F.min("_grank").alias("_start"))
    starts = starts.select(*[F.col(k).alias(f"_k_{k}") for k in group], "_start")
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in group])
    return (
        ranked.join(starts, match)
        .withColumn(name, F.col("_grank") - F.col("_start") + 1)
        .drop("_grank", "_start", *[f"_k_{k}" for k in group])
    )


def top_per_key(df: DataFrame, keys: list[str], order: list, n: int = 1, name: str | None = None) -> DataFrame:
    """First ``n`` rows per key. Spark cuts each map task to ``n`` rows per key before the
    shuffle (window group limit), so a hot key sends only ``n`` rows per task. Above the number
    of rows that Spark does this for, hot keys are spread by one range sort instead."""
    rank = name or "_rank"
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        out = rank_in_group(df, keys, order, rank).filter(F.col(rank) <= n)
        return out if name else out.drop(rank)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    out = df.withColumn(rank, place).filter(F.col(rank) <= n)
    return out if name else out.drop(rank)


def bounded_values(df: DataFrame, value: Column | str, limit: int = 100_000) -> Column:
    """Sorted distinct values as a one-row array, for exploding a small axis.

    At most ``limit + 1`` values are ever gathered; a longer axis is an error,
    because the dense grid it asks for could not be written either.
    """
    value = F.col(value) if isinstance(value, str) else value
    values = df.select(value.alias("_v")).filter(F.col("_v").isNotNull()).distinct().limit(limit + 1)
    gathered = values.agg(F.sort_array(F.collect_list("_v")).alias("_a"))
    return gathered.select(
        F.when(F.size("_a") > limit, F.raise_error(F.lit(f"more than {limit} values on a report axis")))
        .otherwise(F.col("_a"))
        .alias("_a")
    ).scalar()


#: Distinct values of one bracket that a task may sort; a wider bracket is narrowed first.
BRACKET_VALUES = 1 << 16
_BINS = 4096
_STEPS = 256  # coarse classes per factor of e


def _coarse(x: Column) -> Column:
    """Class of a number, never falling as the number grows: even steps of ``log(1 + |x|)``, about 364,000 at most; NaN is the last."""
    size = F.log1p(F.abs(x))
    steps = F.when(size == float("inf"), F.signum(x) * 200_000).otherwise(F.signum(x) * size * _STEPS)
    return F.when(F.isnan(x), F.lit(200_001).cast("long")).otherwise(F.floor(steps).cast("long"))


def _same(group: list[str], *more: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*group, *more]])


def _narrowed(targets: DataFrame, bins: DataFrame, group: list[str], within: list[str], order: str) -> DataFrame:
    """Every target moves into the bin that holds its place. ``bins`` has, per group and bracket, bounded rows of ``_n`` values each."""
    place = Window.partitionBy(*group, *within).orderBy(order)
    placed = bins.withColumn("_before", F.sum("_n").over(place) - F.col("_n"))
    hit = _same(group, *within) & (F.col("l._at") >= F.col("r._before")) & (F.col("l._at") < F.col("r._before") + F.col("r._n"))
    kept = [F.col(f"l.{c}").alias(c) for c in [*group, "n", "_q"]]
    return targets.alias("l").join(placed.alias("r"), hit).select(
        *kept, (F.col("l._at") - F.col("r._before")).alias("_at"), F.col("r._lo").alias("_lo"), F.col("r._hi").alias("_hi"), F.col("r._n").alias("_size")
    )


def _selected(values: DataFrame, group: list[str], targets: DataFrame, coarse: DataFrame) -> DataFrame:
    """``_lo``: the value at place ``_at`` (0-based) of each target's group. Values are counted in classes; only those of a class
    that holds a wanted place are looked at again, equal ones as one row. A bracket of more than ``BRACKET_VALUES`` distinct
    values is cut into bins between its least and greatest value until no such bracket is left; each cut makes it strictly smaller."""
    done = cut(_narrowed(targets, coarse, group, [], "_class"))
    found, todo = done.filter("_lo <=> _hi"), done.filter("NOT _lo <=> _hi")
    widest = todo.agg(F.max("_size")).first()[0]
    if widest is None:
        return found
    spans = todo.select(*group, "_lo", "_hi").distinct()
    held = values.withColumn("_class", _coarse(F.col("_x"))).alias("l").join(
        spans.withColumn("_class", _coarse(F.col("_lo"))).alias("r"), _same(group, "_class")
    )
    held = held.groupBy(*[F.col(f"l.{c}").alias(c) for c in group], F.col("r._lo").alias("_span"), F.col("l._x").alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    held, todo = held if widest <= BRACKET_VALUES else cut(held), todo.withColumn("_span", F.col("_lo"))
    while widest > BRACKET_VALUES and held.groupBy(*group, "_span").count().agg(F.max("count")).first()[0] > BRACKET_VALUES:
        share = F.coalesce(F.try_divide(F.col("_x") - F.col("r._lo"), F.col("r._hi") - F.col("r._lo")), F.lit(0.0))
        spans = todo.select(*group, "_span", "_lo", "_hi").distinct()
        binned = held.alias("l").join(spans.alias("r"), _same(group, "_span")).select(
            *[F.col(f"l.{c}").alias(c) for c in [*group, "_span", "_x", "_n"]], F.least(F.floor(share * _BINS), F.lit(_BINS - 1)).alias("_bin")
        )
        binned = cut(binned)
        bins = binned.groupBy(*group, "_span", "_bin").agg(F.sum("_n").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        todo = cut(_narrowed(todo, bins, group, ["_span"], "_bin"))
        wanted = bins.alias("l").join(todo.select(*group, "_lo").distinct().alias("r"), _same(group, "_lo"), "left_semi")
        chosen = wanted.select(*group, "_span", "_bin", "_lo")
        held = cut(binned.alias("l").join(chosen.alias("r"), _same(group, "_span", "_bin")).select(
            *[F.col(f"l.{c}").alias(c) for c in [*group, "_x", "_n"]], F.col("r._lo").alias("_span")
        ))
        todo = todo.withColumn("_span", F.col("_lo"))
    last = held.withColumn("_lo", F.col("_x")).withColumn("_hi", F.col("_x"))
    return found.unionByName(_narrowed(todo, last, group, ["_span"], "_x"))


def exact_quantiles(
    values: DataFrame,
    group: list[str],
    value: str,
    probs: dict[str, float],
    totals: DataFrame | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles per group, implicit zeros included.

    ``totals(group..., n)`` gives the group size with zeros; stored values fill
    the rest. The wanted order statistics are selected by counts in brackets that
    get narrower: no group is gathered and the values are neither sorted nor written.
    NaN counts as the greatest value, a null value not at all.
    """
    values = values.filter(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_x"))
    coarse = values.groupBy(*group, _coarse(F.col("_x")).alias("_class")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")
    )
    coarse = cut(coarse)
    stats = coarse.groupBy(*group).agg(F.sum("_n").alias("_stored"), F.coalesce(F.sum(F.when(F.col("_class") < 0, F.col("_n"))), F.lit(0)).alias("_neg"))
    if totals is None:
        stats = stats.withColumn("n", F.col("_stored"))
    else:
        stats = totals.select(*group, "n").join(stats, group, "left").fillna(0, ["_stored", "_neg"])
    zeros = F.col("n") - F.col("_stored")

    def place(index: Column) -> Column:
        """Place among the stored values of order statistic ``index`` (0-based); null means zero."""
        return F.when(index < F.col("_neg"), index).when(index >= F.col("_neg") + zeros, index - zeros)

    wanted = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("n") - 1)
        for side, index in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            wanted.append(F.struct(F.struct(F.lit(name).alias("q"), F.lit(side).alias("side"), (at - F.floor(at)).alias("w")).alias("_q"), place(index).alias("_at")))
    targets = stats.filter("n > 0").select(*group, "n", F.explode(F.array(*wanted)).alias("t")).select(*group, "n", "t.*")
    targets = targets if totals is None else cut(targets)
    found = _selected(values, group, targets.filter("_at IS NOT NULL"), coarse).select(*group, "n", "_q", F.col("_lo").alias("_x"))
    found = found.unionByName(targets.filter("_at IS NULL").select(*group, "n", "_q", F.lit(0.0).alias("_x"))).select(*group, "n", "_q.*", "_x")
    parts = []
    for name in probs:
        lo = F.max(F.when((F.col("q") == name) & (F.col("side") == "lo"), F.col("_x")))
        hi = F.max(F.when((F.col("q") == name) & (F.col("side") == "hi"), F.col("_x")))
        w = F.max(F.when(F.col("q") == name, F.col("w")))
        parts.append((lo + F.when(lo == hi, 0.0).otherwise((hi - lo) * w)).alias(name))
    return found.groupBy(*group, "n").agg(*parts)
