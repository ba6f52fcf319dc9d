"""Exact positions and look-back windows over series of any length.

A plain ``Window.partitionBy(entity)`` puts a whole entity into one task.
That is fine for one row per day, but not for an entity that holds a third of
all observations.  The functions here cut each series into bounded pieces
first and still give the exact result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finecast.session import materialise


def position(
    df: DataFrame, by: Sequence[str], order: Sequence[str], chunk: Column | None = None, name: str = "pos"
) -> DataFrame:
    """0-based position of each row within ``by``, ordered by ``order``.

    Rows are numbered inside chunks; chunk sizes are summed per entity over a
    table with one row per chunk; both are added.  No task ever sees more than
    one chunk of one entity.

    ``chunk`` must not decrease along ``order``, for example the month of the
    leading date.  Without it the rows are range-partitioned by entity and
    order, and the partition number is the chunk: pieces of even size for any
    distribution of entities and dates.  The remaining columns end the order, so
    rows with equal keys may fall into several pieces.  That copy is written
    once, because both steps must see the same boundaries.
    """
    by = list(by)
    if chunk is None:
        ties = [F.xxhash64(*[c for c in df.columns if c not in by])]
        ranged = df.repartitionByRange(*[F.col(c) for c in [*by, *order]], *ties)
        tagged = materialise(ranged.withColumn("_chunk", F.spark_partition_id()), "ranged")
        ends = ties
    else:
        tagged, ends = df.withColumn("_chunk", chunk), []
    inside = tagged.withColumn(
        "_rn", F.row_number().over(Window.partitionBy(*by, "_chunk").orderBy(*order)) - 1
    )
    sizes = tagged.groupBy(*by, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *by, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    keys = [*by, "_chunk"]
    return (
        inside.join(offsets, keys)
        .withColumn(name, F.col("_rn") + F.col("_before"))
        .drop("_rn", "_before", "_chunk")
    )


def with_lookback(
    df: DataFrame,
    by: Sequence[str],
    pos: str,
    rows_back: int,
    compute: Callable[[DataFrame, list[str]], DataFrame],
    piece_rows: int = 50_000,
) -> DataFrame:
    """Run a look-back window in pieces of at most ``piece_rows + rows_back`` rows.

    ``pos`` is the 0-based position from :func:`position`.  Each piece also
    receives the ``rows_back`` rows before it, ``compute(frame, keys)`` adds
    its columns with ``Window.partitionBy(*keys).orderBy(pos)``, and the
    borrowed rows are dropped again.
    """
    if rows_back >= piece_rows:
        raise ValueError("rows_back must be smaller than piece_rows")
    own = F.floor(F.col(pos) / piece_rows)
    lends = (F.col(pos) % piece_rows) >= piece_rows - rows_back
    pieces = F.when(lends, F.array(own, own + 1)).otherwise(F.array(own))
    spread = df.withColumn("_piece", F.explode(pieces)).withColumn("_own", F.col("_piece") == own)
    done = compute(spread, [*by, "_piece"])
    return done.filter("_own").drop("_piece", "_own")
