"""Key-preserving joins: merges with cardinality rules, as-of, run selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finecast.errors import DataContractError
from finecast.functions.columns import close
from finecast.operators import guards
from finecast.operators.clean import prefix_columns
from finecast.operators.sets import key_difference

#: Entities of one area that share a task when dates multiply them.
AREA_PART = 10_000


def daily_master(frames: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """J-01: N sources outer-joined one to one on ``keys``; columns become ``source_column``.

    Stacking and grouping gives the full outer join in one shuffle for any N
    (a chain of outer joins shuffles once per step).  A key repeated inside
    one source fails the job while it runs.
    """
    parts = []
    for name, df in frames.items():
        parts.append(prefix_columns(df, f"{name}_", keys).withColumn("_src", F.lit(name)))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    aggs = []
    for name, part in zip(frames, parts):
        copies = F.count_if(F.col("_src") == name)
        for c in part.columns:
            if c not in keys and c != "_src":
                aggs.append(guards.fail_when(copies > 1, f"{name}: duplicate key", F.max(c)).alias(c))
    return stacked.groupBy(*keys).agg(*aggs)


def unique_side(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The rows as they are, failing at run time when a key repeats.

    Rows are numbered within their key, one after the other: no task holds a
    table of all its keys, neither before the shuffle nor after it.  The side is
    left partitioned and sorted by ``keys``, so a following join on those keys
    adds neither a shuffle nor a sort for it.
    """
    values = [c for c in df.columns if c not in keys]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    seen = df.withColumn("_nth", nth)
    return seen.select(*keys, *[guards.fail_when(F.col("_nth") > 1, f"{what}: duplicate key", F.col(c)).alias(c) for c in values])


def spread_side(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """:func:`unique_side` for a side of entities times dates: as many tasks as are set for shuffles, not merged by bytes.

    Such rows shrink so well in a shuffle that tasks of even bytes would hold
    millions of them.  A key must not repeat, so none is hot here.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return unique_side(df.repartition(tasks, *keys), keys, what)


def training_base(forecast: DataFrame, sources: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """J-02: forecast left-joined many-to-one to each source, columns prefixed, policy flags added.

    All joins use the same keys: the forecast is shuffled once and keeps its
    partitioning through the chain.  Small sides are broadcast by Spark when
    their measured size allows it.
    """
    out = forecast
    for name, df in sources.items():
        side = unique_side(prefix_columns(df, f"{name}_", keys), keys, name)
        out = out.join(side, list(keys), "left")
    return out.withColumns(
        {
            "actual_is_reference_only": F.lit(True),
            "synthetic_data_present": F.lit(False),
            "interpolation_present": F.lit(False),
        }
    )


def key_report(df: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """J-13: blank, duplicate, missing and unexpected ids with counts and status."""
    sides = key_difference(master.select(key), df.select(key).filter(F.col(key).isNotNull()), [key])
    sets = sides.agg(
        F.count_if(F.col("side") == "LEFT_ONLY").alias("missing"),
        F.count_if(F.col("side") == "RIGHT_ONLY").alias("unexpected"),
    )
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    blank = F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "")
    dups = per_key.agg(
        F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("blank"),
        F.count_if(~blank & (F.col("n") > 1)).alias("duplicate"),
    )
    names = ["blank", "duplicate", "missing", "unexpected"]
    return (
        sets.withColumns({c: dups.select(c).scalar() for c in ("blank", "duplicate")})
        .unpivot([], names, "check_name", "n_bad")
        .withColumn("status", F.when(F.col("n_bad") == 0, "PASS").otherwise("FAIL"))
    )


def merge_one_to_one(master: DataFrame, sources: Mapping[str, DataFrame], key: str) -> DataFrame:
    """J-03: attach every source one to one as ``source__column``.

    Ids of each source must equal the master's; rows may not multiply and
    columns may not collide.  The ids are counted per side in one narrow
    aggregate that starts the plan, and the job fails on the first id that does
    not stand exactly once on every side; the joins that follow share its
    partitioning, and nothing runs before the merged table is asked for.
    """
    sides = {"master": master, **sources}
    # Never NULL, so that no inferred filter takes a blank id away before the check.
    text = F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key")
    tags = [df.select(text, *[F.lit(1 if n == name else 0).alias(f"_n_{n}") for n in sides]) for name, df in sides.items()]
    ids = reduce(lambda a, b: a.unionByName(b), tags).groupBy("_key").agg(*[F.sum(f"_n_{n}").alias(f"_n_{n}") for n in sides])
    checked = F.when(F.trim("_key") == "", _refuse(F.lit("blank id")))
    for n in sides:
        checked = checked.when(F.col(f"_n_{n}") != 1, _refuse(F.concat(F.lit(f"{n}: ids differ from master or repeat: "), F.col("_key"))))
    out = ids.select(checked.otherwise(F.col("_key")).alias("_key"))
    # Outer joins: an inner one with an empty side would be planned away together with the check.
    out = out.join(master.withColumn("_key", text), "_key", "left")
    for name, df in sources.items():
        side = prefix_columns(df, f"{name}__", [key])
        clash = set(side.columns) & set(out.columns) - {key}
        if clash:
            raise DataContractError(f"{name}: columns already present: {sorted(clash)}")
        out = out.join(side.withColumn("_key", text).drop(key), "_key", "left")
    return out.drop("_key")


def _refuse(message: Column) -> Column:
    return F.raise_error(message).cast("string")


def assemble_leads(daily: DataFrame, keys: Sequence[str], lead: str, values: Sequence[str], leads=range(1, 8)) -> DataFrame:
    """J-04 / A-02: one row per key with ``value_d1`` .. ``value_d7``.

    Conditional aggregates over a known lead list: one shuffle, and no extra
    job to discover the leads.
    """
    return daily.groupBy(*keys).agg(
        *[F.max(F.when(F.col(lead) == d, F.col(v))).alias(f"{v}_d{d}") for v in values for d in leads]
    )


def unpivot_leads(
    wide: DataFrame, keys: Sequence[str], values: Sequence[str], leads=range(1, 8), lead: str = "lead"
) -> DataFrame:
    """A-02 reversed: long rows per lead; leads with no value at all are left out."""
    per_lead = F.array(
        *[
            F.struct(F.lit(d).alias(lead), *[F.col(f"{v}_d{d}").alias(v) for v in values])
            for d in leads
        ]
    )
    out = wide.select(*keys, F.explode(per_lead).alias("_r")).select(*keys, "_r.*")
    return out.dropna(how="all", subset=list(values))


def expand(entities: DataFrame, dates: DataFrame, within: Sequence[str], date_col: str) -> DataFrame:
    """J-05: every entity with every date of its area.

    Dates travel as one sorted array per area (bounded by the calendar).  The
    join therefore keeps one row per entity, and rows multiply only in the
    ``explode`` that follows, inside the tasks that already hold the entities.
    These are dealt out for what they become, not for their bytes: an area of
    many entities is cut into parts of ``AREA_PART``, each with the dates, and
    the number of tasks is the one set for shuffles.
    """
    within = list(within)
    sizes = entities.groupBy(*within).agg(F.ceil(F.count(F.lit(1)) / AREA_PART).alias("_parts"))
    whole = [f.name for f in entities.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    dealt = entities.join(sizes, within).withColumn("_part", F.pmod(F.xxhash64(*whole), F.col("_parts"))).drop("_parts")
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arrays = (
        dates.select(*within, date_col)
        .distinct()
        .groupBy(*within)
        .agg(F.sort_array(F.collect_list(date_col)).alias("_dates"))
    )
    arrays = arrays.join(sizes, within).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")
    joined = dealt.repartition(tasks, *within, "_part").join(arrays.repartition(tasks, *within, "_part"), [*within, "_part"])
    return joined.withColumn(date_col, F.explode("_dates")).drop("_dates", "_part")


def attach(
    frame: DataFrame, forecasts: DataFrame, targets: DataFrame, forecast_keys: Sequence[str],
    target_keys: Sequence[str],
) -> DataFrame:
    """J-06: area forecasts by date, local reference targets by entity and date."""
    side = spread_side(targets, target_keys, "targets")
    return frame.join(forecasts, list(forecast_keys), "left").join(side, list(target_keys), "left")


def attach_target(samples: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J-07: inner join to the genuine target, which must be unique."""
    return samples.join(spread_side(target, keys, "target"), list(keys))


def attach_history(forecast: DataFrame, history: DataFrame, by: Sequence[str], forecast_date: str, date_col: str) -> DataFrame:
    """J-14: past-only history joined by date; a repeated history date fails.

    ``forecast_date`` is the target date for the classic merge, or the issue
    date when lags must not reach past the moment of issue.
    """
    side = unique_side(history, [*by, date_col], "history")
    if forecast_date != date_col:
        side = side.withColumnRenamed(date_col, forecast_date)
    return forecast.join(side, [*by, forecast_date], "left")


def select_run(
    targets: DataFrame, runs: DataFrame, lead: int, run_hours: int = 6, by: Sequence[str] = ()
) -> DataFrame:
    """J-15: forecast steps of the run issued ``lead`` days before each valid day.

    The run must start in [issue, issue + run_hours) and the step must be valid
    within that day.  Both ranges begin at midnight, so the calendar days are
    equi-join keys; the hour test is a filter.
    ``targets(valid_date)``, ``runs(run_created, valid_time, ...)``.
    """
    want = targets.withColumn("issue_date", F.date_sub("valid_date", lead))
    have = runs.filter(F.hour("run_created") < run_hours).withColumns(
        {"issue_date": F.to_date("run_created"), "valid_date": F.to_date("valid_time")}
    )
    return want.join(have, [*by, "issue_date", "valid_date"])


def availability_tag(issue: Column, observed: Column) -> Column:
    """J-16: was the observation dated before the issue time?"""
    return (
        F.when(issue.isNull() | observed.isNull(), "UNKNOWN")
        .when(observed < issue, "DATE_BEFORE_ISSUANCE")
        .otherwise("DATE_NOT_BEFORE_ISSUANCE")
    )


def asof_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str, right_ts: str,
    values: Sequence[str], strict: bool = True, chunk: str = "DAY",
) -> DataFrame:
    """J-17: each left row with the latest right row before (or at) its time.

    Both sides are stacked and scanned per entity and ``chunk`` of time; what
    earlier chunks held comes from a table with one row per chunk.  A busy
    entity is thus spread over its chunks and the result is still exact;
    take HOUR or MINUTE where one entity has very many rows per day.
    Right rows at the same time are ordered by their values.
    """
    by = list(by)
    first, second = (0, 1) if strict else (1, 0)
    obs = F.struct(F.col(right_ts).alias("_rts"), *values)
    l = left.select(F.struct(*left.columns).alias("_left"), *by, F.col(left_ts).cast("timestamp").alias("_ts"),
                    F.lit(first).alias("_kind"))
    r = right.select(*by, F.col(right_ts).cast("timestamp").alias("_ts"), F.lit(second).alias("_kind"), obs.alias("_obs"))
    both = l.unionByName(r, allowMissingColumns=True).withColumn("_chunk", F.date_trunc(chunk, "_ts"))
    inside = Window.partitionBy(*by, "_chunk").orderBy("_ts", "_kind", "_obs").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    seen = both.withColumn("_in", F.last("_obs", ignorenulls=True).over(inside)).filter("_left is not null")
    ends = both.groupBy(*by, "_chunk").agg(F.max("_obs").alias("_end"))
    earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(*by, "_chunk", F.last("_end", ignorenulls=True).over(earlier).alias("_carry"))
    out = seen.join(carry, [*by, "_chunk"], "left").withColumn("_hit", F.coalesce("_in", "_carry"))
    return out.select("_left.*", F.col("_hit._rts").alias(right_ts), *[F.col(f"_hit.{v}").alias(v) for v in values])


def match_rates(
    forecast: DataFrame, obs: DataFrame, by: Sequence[str], columns: Mapping[str, str], target_date: str,
    issue_date: str, obs_date: str, tol: float = 1e-8,
) -> DataFrame:
    """J-18: how often ``forecast`` columns equal the observation on the target and on the issue date.

    ``columns`` maps forecast column to observation column.  Two left joins on
    equi keys, one aggregate.
    """
    side = unique_side(obs.select(*by, obs_date, *set(columns.values())), [*by, obs_date], "observations")

    def renamed(day: str, tag: str) -> DataFrame:
        return side.select(*by, F.col(obs_date).alias(day), *[F.col(v).alias(f"{tag}_{v}") for v in set(columns.values())])

    joined = forecast.join(renamed(target_date, "t"), [*by, target_date], "left").join(
        renamed(issue_date, "i"), [*by, issue_date], "left"
    )
    aggs = []
    for f, o in columns.items():
        for tag in ("t", "i"):
            a, b = F.col(f), F.col(f"{tag}_{o}")
            both = a.isNotNull() & b.isNotNull()
            aggs += [
                F.count_if(both).alias(f"{f}|{tag}|n"),
                F.avg(F.when(both, close(a, b, tol, tol).cast("int"))).alias(f"{f}|{tag}|rate"),
            ]
    row = joined.agg(*aggs)
    parts = F.array(
        *[
            F.struct(
                F.lit(f).alias("column_name"),
                F.col(f"`{f}|t|n`").alias("target_n"),
                F.col(f"`{f}|t|rate`").alias("target_rate"),
                F.col(f"`{f}|i|n`").alias("issue_n"),
                F.col(f"`{f}|i|rate`").alias("issue_rate"),
            )
            for f in columns
        ]
    )
    return row.select(F.explode(parts).alias("r")).select("r.*")


def scenario_difference(base: DataFrame, scenario: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """J-19: scenario minus base; NULL on either side stays NULL."""
    s = scenario.select(*keys, *[F.col(v).alias(f"s_{v}") for v in values])
    return base.select(*keys, *values).join(s, list(keys), "left").select(
        *keys, *[(F.col(f"s_{v}") - F.col(v)).alias(f"{v}_delta") for v in values]
    )


def registry_with_outputs(
    registry: DataFrame, outputs: DataFrame, keys: Sequence[str], alias_col: str, aliases: Mapping[str, str]
) -> DataFrame:
    """J-21: official list full-joined with computed outputs, old names mapped, availability flagged."""
    renamed = outputs
    if aliases:
        table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        renamed = outputs.withColumn(alias_col, F.coalesce(F.element_at(table, F.col(alias_col)), F.col(alias_col)))
    return (
        registry.withColumn("_official", F.lit(True))
        .join(renamed.withColumn("_computed", F.lit(True)), list(keys), "full_outer")
        .withColumns(
            {
                "official": F.coalesce("_official", F.lit(False)),
                "available": F.coalesce("_computed", F.lit(False)),
            }
        )
        .drop("_official", "_computed")
    )
