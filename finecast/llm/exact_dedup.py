"""Exact duplicates: 128-bit content hash, then the bytes themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finecast.llm.shared import SPACE, present


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` with its group; internal columns start with ``_x``.

    Two texts are equal when their bytes are, after deleting ``SPACE``
    characters.  Rows are grouped by a 128-bit hash and, inside it, by the
    normalised bytes, so two texts with one hash stay apart.  Equal texts of a
    task collapse before the shuffle, so a group of any size costs one row a
    task.  The keeper is the row with the most code points, then the smallest
    id; ids that are null come last; rows equal in all of that are told apart
    by their place in the input, which should be a stored table.  Null text
    counts as empty; an empty table gives no rows.  Rows meet their group by a
    plain join on hash and digest, which adaptive execution splits for large
    groups.

    Adds ``_xkeep`` (id), ``_xsize``, ``_xkept`` and ``_xsha`` (sha-256 of the
    normalised text).
    """
    body = present(F.col(text))
    rows = (
        docs.withColumn("_xnorm", F.regexp_replace(body, SPACE, ""))
        .withColumn("_xrank", F.struct((-F.length(body)).alias("c"), F.col(doc_id).isNull().alias("n"), F.col(doc_id).alias("i"), F.monotonically_increasing_id().alias("p")))
        .withColumn("_xhash", F.md5(F.col("_xnorm").cast("binary")))
    )
    groups = (
        rows.groupBy("_xhash", "_xnorm")
        .agg(F.min("_xrank").alias("_xbest"), F.count("*").alias("_xsize"))
        .select("_xhash", F.sha2(F.col("_xnorm").cast("binary"), 256).alias("_xsha"), "_xbest", "_xsize")
    )
    keyed = rows.withColumn("_xsha", F.sha2(F.col("_xnorm").cast("binary"), 256)).drop("_xnorm")
    return (
        keyed.join(groups, ["_xhash", "_xsha"])
        .withColumn("_xkeep", F.col("_xbest.i"))
        .withColumn("_xkept", F.col("_xbest.p") == F.col("_xrank.p"))
        .drop("_xbest", "_xrank", "_xhash")
    )


def exact_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: id, keeper, group size, kept, digest."""
    return exact_groups(docs, text, doc_id).select(
        F.col(doc_id), F.col("_xkeep").alias("keep_id"), F.col("_xsize").alias("group_size"), F.col("_xkept").alias("kept"), F.col("_xsha").alias("text_sha256")
    )


def drop_exact(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The kept rows of ``docs`` with the columns they came with."""
    return exact_groups(docs, text, doc_id).where("_xkept").select(*[F.col(f"`{c}`") for c in docs.columns])
