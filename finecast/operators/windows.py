"""Past-only history, look-back windows, spatial scores, ranks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finecast.errors import DataContractError
from finecast.functions.columns import clip
from finecast.operators.ordered import with_lookback
from finecast.operators.quantiles import exact_medians, long_form

# Lags, windows, score clip; variable families and name scores.
LAGS = (1, 3, 7)
WINDOWS = (3, 7, 14)
SCORE_CLIP = 5.0
FAMILIES = {
    "rain": ("rain", "precip"),
    "temperature": ("temp", "temperature"),
    "humidity": ("humidity",),
    "wind": ("wind",),
    "pressure": ("pressure",),
    "dewpoint": ("dewpoint", "dew_point"),
}
NAME_SCORES = {"mean": 50, "2m": 20, "std": -20, "max": -10, "min": -10}


def history_columns(
    by: Sequence[str], order: str, columns: Sequence[str], rain: Iterable[str] = (),
    lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS,
) -> dict[str, Column]:
    """W-01..W-03 as expressions, positional (rows, not calendar days).

    A rolling value needs all ``w`` previous rows non-NULL.  Wet days count a
    NULL as dry and begin one row earlier than the sums.
    All frames share one partitioning and order, so Spark sorts once.
    """
    o = Window.partitionBy(*by).orderBy(order)
    rain = set(rain)
    out: dict[str, Column] = {}
    for c in columns:
        v = F.col(c)
        for n in lags:
            out[f"hist__{c}__lag_{n}d"] = F.lag(v, n).over(o)
        for w in windows:
            f = o.rowsBetween(-w, -1)
            full = F.count(v).over(f) == w
            out[f"hist__{c}__rolling_mean_{w}d"] = F.when(full, F.avg(v).over(f))
            out[f"hist__{c}__rolling_std_{w}d"] = F.when(full, F.stddev_samp(v).over(f))
            if c in rain:
                out[f"hist__{c}__rolling_sum_{w}d"] = F.when(full, F.sum(v).over(f))
                wet = F.sum(F.coalesce((v > 0).cast("int"), F.lit(0))).over(f)
                out[f"hist__{c}__wet_days_{w}d"] = F.when(F.row_number().over(o) >= w, F.coalesce(wet, F.lit(0)))
    return out


def history_features(
    df: DataFrame, by: Sequence[str], order: str, columns: Sequence[str], rain: Iterable[str] = (),
    lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS,
) -> DataFrame:
    """W-01..W-03 for series with one row per day (bounded by the calendar)."""
    cols = history_columns(by, order, columns, rain, lags, windows)
    return df.select("*", *[c.alias(n) for n, c in cols.items()])


def history_features_long(
    df: DataFrame, by: Sequence[str], pos: str, columns: Sequence[str], rain: Iterable[str] = (),
    lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS, piece_rows: int = 50_000,
) -> DataFrame:
    """The same features for series of any length, computed in bounded pieces.

    ``pos`` is a 0-based position (see ``ordered.position``).  Wet days look at
    the position instead of a row number, since a piece starts in mid-series.
    """
    rain = set(rain)
    back = max([*lags, *windows])

    def compute(frame: DataFrame, keys: list[str]) -> DataFrame:
        cols = history_columns(keys, pos, columns, rain, lags, windows)
        for c in rain & set(columns):
            for w in windows:
                f = Window.partitionBy(*keys).orderBy(pos).rowsBetween(-w, -1)
                wet = F.sum(F.coalesce((F.col(c) > 0).cast("int"), F.lit(0))).over(f)
                cols[f"hist__{c}__wet_days_{w}d"] = F.when(F.col(pos) + 1 >= w, F.coalesce(wet, F.lit(0)))
        return frame.select("*", *[c.alias(n) for n, c in cols.items()])

    return with_lookback(df, by, pos, back, compute, piece_rows)


def primary_variables(columns: Sequence[str], excluded: Sequence[str] = ()) -> list[str]:
    """W-04: best-named column of each weather family; names only, no data."""
    chosen: list[str] = []
    for tokens in FAMILIES.values():
        members = [c for c in columns if c not in excluded and any(t in c.lower() for t in tokens)]
        if members:
            best = max(members, key=lambda c: sum(s for t, s in NAME_SCORES.items() if t in c.lower()))
            if best not in chosen:  # one column serves one family
                chosen.append(best)
    return chosen


def primary_from_dictionary(
    dictionary: DataFrame, columns: Sequence[str], targets: Sequence[str], dataset: str = "block_observations_daily", group: str = "historical_weather",
    name: str = "column_name",
) -> DataFrame:
    """W-04 as the reference catalogue asks: only dictionary rows of one dataset and group, present in the data and no target."""
    fit = (F.col("source_dataset") == dataset) & (F.col("feature_group") == group)
    return primary_report(dictionary.filter(fit & F.col(name).isin(list(columns)) & ~F.col(name).isin(list(targets))), name)


def primary_report(dictionary: DataFrame, name: str = "column_name") -> DataFrame:
    """W-04 over a dictionary table: (family, column_name), first row wins ties by ``position``.

    A column that is the best of several families stands under the first alone.
    """
    low = F.lower(F.col(name))
    score = sum((F.when(low.contains(t), s).otherwise(0) for t, s in NAME_SCORES.items()), F.lit(0))
    families = F.array(
        *[
            F.when(low.rlike("|".join(tokens)), F.lit(fam))
            for fam, tokens in FAMILIES.items()
        ]
    )
    tagged = dictionary.select(name, "position", score.alias("_s"), F.explode(F.array_compact(families)).alias("family"))
    best = tagged.groupBy("family").agg(F.min_by(name, F.struct(-F.col("_s"), F.col("position"))).alias(name))
    rank = F.array_position(F.array(*[F.lit(f) for f in FAMILIES]), F.col("family"))
    return best.groupBy(name).agg(F.min_by("family", rank).alias("family")).select("family", name)


def _daily_parts(obs: DataFrame, by: Sequence[str], date_col: str, values: Sequence[str]) -> DataFrame:
    """Sums and counts per entity and day: the bounded grain all look-backs share."""
    return obs.groupBy(*by, date_col).agg(
        *[F.sum(v).alias(f"s_{v}") for v in values], *[F.count(v).alias(f"c_{v}") for v in values]
    )


def lookback(
    obs: DataFrame, by: Sequence[str], date_col: str, values: Sequence[str], days: Sequence[int],
    end: Column | None = None,
) -> DataFrame:
    """W-05: means over look-back windows.

    Without ``end`` each entity is anchored at its own newest date and the
    window is closed on both sides.  With ``end`` the anchor is global and the
    window is [end - d, end).
    """
    parts = _daily_parts(obs, by, date_col, values)
    if end is None:
        anchor = parts.groupBy(*by).agg(F.max(date_col).alias("_end"))
        parts = parts.join(anchor, list(by))
        def hit(d):
            return F.col(date_col).between(F.date_sub("_end", d), F.col("_end"))
    else:
        def hit(d):
            return (F.col(date_col) >= F.date_sub(end, d)) & (F.col(date_col) < end)
    aggs = []
    for v in values:
        for d in days:
            n = F.sum(F.when(hit(d), F.col(f"c_{v}")))
            aggs.append(F.try_divide(F.sum(F.when(hit(d), F.col(f"s_{v}"))), n).alias(f"{v}_mean_{d}d"))
            aggs.append(F.coalesce(n, F.lit(0)).alias(f"{v}_count_{d}d"))
    return parts.groupBy(*by).agg(*aggs)


def change(obs: DataFrame, by: Sequence[str], date_col: str, values: Sequence[str], end: Column, days: int = 30) -> DataFrame:
    """W-06: mean of the last period minus mean of the one before; NULL if either is empty."""
    d = F.col(date_col)
    now = (d >= F.date_sub(end, days)) & (d < end)
    before = (d >= F.date_sub(end, 2 * days)) & (d < F.date_sub(end, days))
    return obs.groupBy(*by).agg(
        *[
            (F.avg(F.when(now, F.col(v))) - F.avg(F.when(before, F.col(v)))).alias(f"{v}_change_{days}d")
            for v in values
        ]
    )


def staleness(obs: DataFrame, by: Sequence[str], date_col: str, values: Sequence[str], end: Column) -> DataFrame:
    """W-07: days since the newest observation with any value."""
    newest = F.max(F.when(F.coalesce(*values).isNotNull(), F.col(date_col)))
    return obs.groupBy(*by).agg(newest.alias("latest_valid_date"), F.datediff(end, newest).alias("days_since_valid"))


def allocation_weights(df: DataFrame, group: Sequence[str], score: str, name: str = "weight") -> DataFrame:
    """W-08: softmax of the clipped score inside each group.

    Group sums are aggregated and joined back, so a group with very many
    members is never gathered.  A NULL score fails the job.
    """
    guarded = F.when(F.col(score).isNull(), F.raise_error(F.lit("score is missing"))).otherwise(F.col(score))
    raised = df.withColumn("_e", F.exp(clip(guarded, -SCORE_CLIP, SCORE_CLIP)))
    sums = raised.groupBy(*group).agg(F.sum("_e").alias("_sum"))
    return raised.join(sums, list(group)).withColumn(name, F.col("_e") / F.col("_sum")).drop("_e", "_sum")


def weight_report(weights: DataFrame, group: Sequence[str], name: str = "weight", tol: float = 1e-10) -> DataFrame:
    """W-08 audit: count, sum and sign per group."""
    return weights.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(name).alias("weight_sum"),
        (F.abs(F.sum(name) - 1.0) <= tol).alias("conserved"),
        (F.count_if(F.col(name) <= 0) == 0).alias("all_positive"),
    )


def require_weights(weights: DataFrame, group: Sequence[str], name: str = "weight") -> DataFrame:
    r = weight_report(weights, group, name).agg(
        F.count_if(~F.col("conserved") | ~F.col("all_positive")).alias("bad"),
        F.min("n").alias("lo"),
        F.max("n").alias("hi"),
    ).first()
    if r["bad"] or r["lo"] != r["hi"]:
        raise DataContractError(f"weights not conserved or unequal group sizes: {r.asDict()}")
    return weights


def block_anomaly(df: DataFrame, block: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """W-09: value minus block median; NULL for columns with < 2 values or constant in the block."""
    cols = {c: F.col(c) for c in columns}
    spread = long_form(df, block, cols).groupBy(*block, "column_name").agg(
        F.count(F.lit(1)).alias("_n"), (F.min("value") != F.max("value")).alias("_varies")
    )
    med = exact_medians(df, block, cols).join(spread, [*block, "column_name"]).filter("_n >= 2 and _varies")
    wide = med.groupBy(*block).agg(
        *[F.max(F.when(F.col("column_name") == c, F.col("median"))).alias(f"_m_{c}") for c in columns]
    )
    joined = df.join(wide, list(block), "left")
    return joined.select(
        *df.columns, *[(F.col(c) - F.col(f"_m_{c}")).alias(f"spatial__{c}__block_median_anomaly") for c in columns]
    )


def spatial_score(df: DataFrame, block: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """W-10: standardise (population std), RMS distance from the mean, z-score of that distance.

    Missing cells take the block median first.  A zero std counts as one.
    """
    cols = {c: F.col(c) for c in columns}
    med = exact_medians(df, block, cols).groupBy(*block).agg(
        *[F.max(F.when(F.col("column_name") == c, F.col("median"))).alias(f"_m_{c}") for c in columns]
    )
    filled = df.join(med, list(block), "left").withColumns({f"_v_{c}": F.coalesce(c, f"_m_{c}") for c in columns})
    stats = filled.groupBy(*block).agg(
        *[F.avg(f"_v_{c}").alias(f"_a_{c}") for c in columns],
        *[F.stddev_pop(f"_v_{c}").alias(f"_s_{c}") for c in columns],
    )
    z = [
        F.pow((F.col(f"_v_{c}") - F.col(f"_a_{c}")) / F.when(F.col(f"_s_{c}") > 1e-12, F.col(f"_s_{c}")).otherwise(1.0), 2)
        for c in columns
    ]
    total = z[0]
    for q in z[1:]:
        total = total + q
    dist = filled.join(stats, list(block)).withColumn("spatial_distance_from_mean", F.sqrt(total / len(columns)))
    d = dist.groupBy(*block).agg(
        F.avg("spatial_distance_from_mean").alias("_da"), F.stddev_pop("spatial_distance_from_mean").alias("_ds")
    )
    scale = F.when(F.col("_ds") > 1e-12, F.col("_ds")).otherwise(1.0)
    return dist.join(d, list(block)).select(
        *df.columns,
        "spatial_distance_from_mean",
        ((F.col("spatial_distance_from_mean") - F.col("_da")) / scale).alias("spatial_anomaly_score"),
    )


def horizon_position(df: DataFrame, by: Sequence[str], date_col: str, name: str = "forecast_horizon_day") -> DataFrame:
    """W-11: the d-th forecast row by date is D*d* (rows per cycle are few by nature)."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(date_col)))


def above_own_mean(df: DataFrame, by: Sequence[str], value: str, delta: float) -> DataFrame:
    """W-13: rows above the group mean by more than ``delta``.

    A value may lie at the mean plus ``delta`` to the last bit, so the sum is
    taken in decimals, which no order of the rows changes.  Values that
    decimals do not hold to a double's precision have a sum of doubles.
    """
    exact = F.col(value).try_cast("decimal(38,18)")
    held = (F.count(exact) == F.count(value)) & (F.max(F.abs(value)) >= 0.01)
    mean = F.when(held, F.try_sum(exact).cast("double") / F.count(value))
    means = df.groupBy(*by).agg(F.coalesce(mean, F.avg(value)).alias("own_mean"))
    return df.join(means, list(by)).withColumn("above", F.col(value) > F.col("own_mean") + delta)


def rank_within(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int | None = None, name: str = "rank") -> DataFrame:
    """W-12: position inside the group; with ``n`` Spark keeps only n rows per group before the shuffle."""
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return out if n is None else out.filter(F.col(name) <= n)


def ordered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """T-01: total output order, remaining columns break ties."""
    return df.orderBy(*columns, *[c for c in df.columns if c not in columns])


def peak_day(df: DataFrame, by: Sequence[str], value: str, date_col: str) -> DataFrame:
    """T-03: date of the largest value, earliest on ties."""
    present = df.filter(F.col(value).isNotNull())
    return present.groupBy(*by).agg(
        F.min_by(date_col, F.struct(-F.col(value), F.col(date_col))).alias("peak_date"),
        F.max(value).alias("peak_value"),
    )


def latest(df: DataFrame, by: Sequence[str], ts: str, values: Sequence[str]) -> DataFrame:
    """T-04: newest row per key; ties by the values themselves."""
    pick = F.max(F.struct(ts, *values)).alias("_r")
    return df.groupBy(*by).agg(pick).select(*by, "_r.*")
