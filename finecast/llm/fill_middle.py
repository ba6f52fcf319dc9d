"""Fill-in-middle: texts cut in three by one match of a pattern that counts its tokens."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finecast.llm.shared import present

# What a text is cut into, the marks of prefix, suffix and middle, shares in percent.
UNIT = "[A-Za-z]+|[^A-Za-z]"
MARKS = ("<P>", "<S>", "<M>")
PLAIN, SPM = 10, 20
SEED = 1

#: Names that ``fill_middle`` adds, replacing columns of these names.
ADDED = ("fim_tokens", "fim_form", "fim_output", "fim_prefix_chars", "fim_middle_chars")


def draws(doc_id: Column, seed: int, n: int) -> list[Column]:
    """``n`` numbers of 32 bits from the hash of seed and id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), present(doc_id)).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def _holds(text: Column, mark: str) -> Column:
    return F.contains(text, F.lit(mark))


def _kept(mark: str) -> str:
    """A mark as it stands in the replacement of a pattern."""
    return mark.replace("\\", "\\\\").replace("$", "\\$")


def fill_middle(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", marks: tuple[str, str, str] = MARKS, plain: int = PLAIN, spm: int = SPM, seed: int = SEED
) -> DataFrame:
    """Every row of ``docs`` with its text rearranged for infilling.

    A text of n tokens is cut after a and after b tokens, a <= b, drawn from
    the hash of seed and id.  ``regexp_count`` gives n; the row's own pattern
    ``(unit{a})(unit{b-a})(rest)`` takes the whole text in one match, and the
    replacement lays the three groups out.  The groups are possessive: Java
    then runs the counted repetition as a loop and keeps no way back, so depth
    and memory do not grow with the text.

    Adds ``fim_tokens`` (n), ``fim_form`` (plain, psm or spm), ``fim_output``,
    ``fim_prefix_chars`` and ``fim_middle_chars`` (code points, null if plain),
    replacing columns of these names; all other columns stay.  ``plain`` percent
    of the rows stay as they are, so do texts that are empty or hold a mark;
    ``spm`` percent of the others start with the suffix.  Null text counts as
    empty, a null id as an empty one; rows with equal id and text get equal
    results; an empty table gives no rows.  No row meets another: there is no
    shuffle, and a very long text is one value of one row.
    """
    t = present(F.col(text))
    body = docs.drop(*ADDED).withColumn("_fim_text", t).withColumn("fim_tokens", F.regexp_count(F.col("_fim_text"), F.lit(UNIT)).cast("long"))
    h1, h2, h3, h4 = draws(F.col(doc_id), seed, 4)
    n = F.col("fim_tokens")
    held = F.lit(False)
    for m in marks:
        held = held | _holds(F.col("_fim_text"), m)
    drawn = body.withColumn("_fim_cuts", F.array(h1 % (n + 1), h2 % (n + 1))).withColumn(
        "fim_form",
        F.when((F.col("_fim_text") == "") | held | (h3 % 100 >= 100 - plain), "plain").when(h4 % 100 < spm, "spm").otherwise("psm"),
    )
    a, b = F.array_min("_fim_cuts"), F.array_max("_fim_cuts")
    unit = "(?:[A-Za-z]++|[^A-Za-z])"
    pattern = F.concat(F.lit(rf"(?s)\A({unit}{{"), a, F.lit(rf"}}+)({unit}{{"), b - a, F.lit(r"}+)(.*+)\z"))
    p, s, m = (_kept(x) for x in marks)
    laid = F.when(F.col("fim_form") == "psm", f"{p}$1{s}$3{m}$2").when(F.col("fim_form") == "spm", f"{s}$3{p}$1{m}$2")
    out = drawn.withColumn(
        "fim_output", F.when(F.col("fim_form") == "plain", F.col("_fim_text")).otherwise(F.regexp_replace(F.col("_fim_text"), pattern, laid))
    )
    # Marks stand once in an output that is not plain, so their places give the lengths.
    at = [F.locate(x, F.col("fim_output")) for x in marks]
    prefix = F.when(F.col("fim_form") == "psm", at[1] - len(marks[0]) - 1).when(F.col("fim_form") == "spm", at[2] - at[0] - len(marks[0]))
    middle = F.length("fim_output") - at[2] - (len(marks[2]) - 1)
    return out.withColumn("fim_prefix_chars", prefix.cast("long")).withColumn(
        "fim_middle_chars", F.when(F.col("fim_form") != "plain", middle).cast("long")
    ).drop("_fim_text", "_fim_cuts")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``output`` was made from, exactly.

    Parts before a mark hold none, so the first place of each mark is its own.
    """
    p, s, m = (re.escape(x) for x in marks)
    psm = F.regexp_replace(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_middle_report(docs: DataFrame) -> DataFrame:
    """One row per input row: id, tokens, form, lengths, digests of the output and of the text rebuilt from it."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return fill_middle(docs).select(
        "doc_id", F.col("fim_tokens").alias("n"), F.col("fim_form").alias("form"), F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"), sha(F.col("fim_output")).alias("output_sha256"),
        sha(restored(F.col("fim_output"), F.col("fim_form"))).alias("restored_sha256"),
    )
