"""Exact quantiles without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finecast.session import materialise

# Distinct values one group may hold in a single aggregation buffer, and the
# number of slices a larger group is cut into.
GROUP_VALUES, SLICES = 100_000, 256


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float],
    group_values: int = GROUP_VALUES, slices: int = SLICES,
) -> DataFrame:
    """Linear-interpolated quantiles per group, equal to sorting the group.

    Distinct values are counted per group first: the shuffle key includes the
    value, so a hot group spreads over all tasks.  The counts are written to
    the shared folder because every later step reads them.  Groups with at most
    ``group_values`` distinct values use the built-in ``percentile`` over
    (value, count); larger ones are sliced, see :func:`_sliced`.  NULLs are
    ignored; groups with no value are absent.
    """
    by = list(by)
    gb = by or ["_all"]
    src = df.select(*by, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    if not by:
        src = src.withColumn("_all", F.lit(1))
    counts = materialise(src.groupBy(*gb, "_v").agg(F.count(F.lit(1)).alias("_c")), "quantile-counts")
    sizes = counts.groupBy(*gb).agg(F.count(F.lit(1)).alias("_d"), F.sum("_c").alias("_n"))
    many = sizes.filter(F.col("_d") > group_values).select(*gb, "_n")
    sliced = not many.isEmpty()
    few = counts.join(many.select(*gb), gb, "left_anti") if sliced else counts
    at = F.array(*[F.lit(float(p)) for p in probs.values()])
    out = few.groupBy(*gb).agg(F.percentile("_v", at, F.col("_c")).alias("_q")).select(
        *gb, *[F.col("_q")[i].alias(n) for i, n in enumerate(probs)]
    )
    if sliced:
        out = out.unionByName(_sliced(counts, many, gb, probs, slices))
    return out if by else out.drop("_all")


def _sliced(counts: DataFrame, groups: DataFrame, gb: list[str], probs: dict[str, float], slices: int) -> DataFrame:
    """Quantiles of groups too large for one buffer.

    1. A bounded sketch over the distinct values gives cut points.  They only
       decide the slicing, so their error never reaches the result.
    2. Slice totals, at most ``slices`` per group, locate the slices holding
       the wanted ranks.
    3. Only those slices are ranked value by value, each in its own task.
    """
    mine = counts.join(groups, gb)
    cuts_at = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    cuts = mine.groupBy(*gb).agg(F.percentile_approx("_v", cuts_at, 10 * slices).alias("_cuts"))
    sliced = mine.join(cuts, gb).withColumn("_slice", F.size(F.filter("_cuts", lambda c: c < F.col("_v"))))
    totals = sliced.groupBy(*gb, "_slice").agg(F.sum("_c").alias("_sc"), F.first("_n").alias("_n"))
    run = Window.partitionBy(*gb).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_from", F.coalesce(F.sum("_sc").over(run), F.lit(0)))
    wanted = F.explode(
        F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p")) for n, p in probs.items()])
    )
    at = F.col("_w.p") * (F.col("_n") - 1)
    ranks = totals.select("*", wanted.alias("_w")).select(
        *gb, "_slice", "_from", "_sc", F.col("_w.name").alias("_name"), at.alias("_at"),
        F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))).alias("_rank"),
    )
    ranks = ranks.filter((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_from") + F.col("_sc")))
    touched = ranks.select(*gb, "_slice", "_from").distinct()
    inside = Window.partitionBy(*gb, "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = sliced.join(touched, [*gb, "_slice"]).withColumn("_to", F.col("_from") + F.sum("_c").over(inside))
    placed = placed.select(*gb, "_slice", "_v", (F.col("_to") - F.col("_c")).alias("_lo"), "_to")
    found = ranks.drop("_from", "_sc").join(placed, [*gb, "_slice"]).filter(
        (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_to"))
    )
    # One or two neighbours per group and quantile.
    parts = found.groupBy(*gb, "_name").agg(
        F.min_by("_v", "_rank").alias("_a"), F.max_by("_v", "_rank").alias("_b"),
        F.first(F.col("_at") - F.floor("_at")).alias("_part"),
    )
    value_at = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")
    return parts.groupBy(*gb).agg(*[F.max(F.when(F.col("_name") == n, value_at)).alias(n) for n in probs])


def long_form(df: DataFrame, by: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    """(by, column_name, value): one row per input row and named column."""
    cells = F.array(
        *[F.struct(F.lit(n).alias("column_name"), c.cast("double").alias("value")) for n, c in columns.items()]
    )
    return df.select(*by, F.explode(cells).alias("_c")).select(*by, "_c.*").filter("value is not null")


def exact_medians(df: DataFrame, by: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    """Exact medians of several columns at once: (by, column_name, median)."""
    return exact_quantiles(long_form(df, by, columns), [*by, "column_name"], "value", {"median": 0.5})


def medians_wide(df: DataFrame, by: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    """Exact medians per group as ``<name>_median`` columns."""
    long = exact_medians(df, by, columns)
    return long.groupBy(*by).agg(
        *[F.max(F.when(F.col("column_name") == n, F.col("median"))).alias(f"{n}_median") for n in columns]
    )
