"""Mix of sources to target weights, with a cap on repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finecast.llm.shared import SPACE, present, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = 17
#: Slices of the seeded order of a source; only the slice that holds the cut is sorted.
SLICES = 1 << 16
BROADCAST_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.regexp_count(present(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Adds ``target`` to (source, source_size).

    Sources by code point, null last, have the weights in turn.  They share
    ``share`` times all words by weight; what a source would get beyond
    ``epochs`` times its size goes to the others by weight, until none is above.
    That fixed point is the level L with target = least(cap, weight * L):
    sources fill up in the order of cap / weight, so L follows from running
    sums over the sources (one row each).  If all fill up, each has its cap.
    """
    rank = Window.orderBy(F.col("source").isNull(), "source")
    fill = Window.orderBy("ratio", "at")
    everything = Window.partitionBy()
    weighted = (
        sources.withColumn("at", F.row_number().over(rank) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("at") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.lit(float(epochs)) * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        weighted.withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(everything))
        .withColumn("filled", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("budget") - F.col("filled")) / F.col("left"))
        # The first source that the level does not fill: its level holds for all.
        .withColumn("flood", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "at", "level"))).over(everything))
    )
    return levels.select("source", "source_size", F.coalesce(F.least("cap", F.col("weight") * F.col("flood.level")), "cap").alias("target"))


def _order(doc_id: str, seed: int) -> Column:
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))


def mix(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = SEED, text: str = "text", doc_id: str = "doc_id", source: str = "source"
) -> DataFrame:
    """(id, source, size, source_size, target, repeats, taken), one row per document.

    A source's target is a number of passes over it: every document is taken
    the whole number of times, and a seeded part of them once more, in the order
    of the md5 of id and seed, for as long as at least half of the next fits into
    what is left of the target; so a source misses it by half a document at most.
    The cut is found from word sums over slices of that order, then inside the
    one slice that holds it: no source is sorted or gathered as a whole.  The
    order depends on id and seed alone, so reruns and retries agree; rows that
    share source and id are chosen together or not at all.  Null text has size
    0; null is a source of its own; a source without words takes none.
    """
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"), _order(doc_id, seed).alias("_o"))
    sized = written(sized.withColumn("_s", F.conv(F.substring("_o", 1, 8), 16, 10).cast("long").bitwiseAND(SLICES - 1)), "sizes")
    slices = written(sized.groupBy("source", "_s").agg(F.sum("size").alias("words")), "slices")
    totals = slices.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = targets(totals, weights, share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0).cast("long"))
    plan = plan.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = written(plan, "plan")
    near = F.broadcast if plan.count() <= BROADCAST_ROWS else lambda d: d
    # Running words before each slice, over at most SLICES rows of a source.
    run = Window.partitionBy("source").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        slices.withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0).cast("long")))
        .join(near(plan.select(F.col("source").alias("_ps"), "rest")), F.col("source").eqNullSafe(F.col("_ps")))
        .where("before <= rest AND before + words > rest")
        .select(F.col("source").alias("_cs"), F.col("_s").alias("cut"), "before")
    )
    cuts = written(cuts, "cuts")
    joined = (
        sized.join(near(plan.withColumnRenamed("source", "_ps")), F.col("source").eqNullSafe(F.col("_ps")))
        .join(near(cuts), F.col("source").eqNullSafe(F.col("_cs")), "left")
        .drop("_ps", "_cs")
    )
    edge = joined.where("_s = cut").groupBy("source", "_o", "rest", "before").agg(F.sum("size").alias("w"))
    inside = Window.partitionBy("source").orderBy("_o").rowsBetween(Window.unboundedPreceding, 0)
    chosen = edge.withColumn("upto", F.col("before") + F.sum("w").over(inside)).where("2 * upto - w <= 2 * rest").select(F.col("source").alias("_es"), F.col("_o").alias("_eo"))
    more = (F.col("rest") > 0) & (F.col("cut").isNull() | (F.col("_s") < F.col("cut")) | F.col("_eo").isNotNull())
    return (
        joined.join(chosen, F.col("source").eqNullSafe(F.col("_es")) & (F.col("_o") == F.col("_eo")) & (F.col("_s") == F.col("cut")), "left")
        .withColumn("repeats", F.col("whole") + F.when(more, 1).otherwise(0))
        .select("doc_id", "source", "size", "source_size", "target", F.col("repeats").cast("long"), (F.col("size") * F.col("repeats")).alias("taken"))
    )


def mix_report(docs: DataFrame, **options) -> DataFrame:
    return mix(docs, **options).select("doc_id", "size", "source_size", "target", "taken")
