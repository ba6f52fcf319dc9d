"""Benchmark passages in training text, found by hashed word windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finecast.llm.shared import ascii_lower, present, written

WINDOW = 10
BROADCAST_BYTES = 32 << 20
#: Words of a stretch of text whose positions are tried together: what a position carries does not grow with its text.
STRETCH = 64
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(present(text)), NOT_WORD), "")


def _key(words: str, at: str, length: int) -> Column:
    """Hash of ``length`` words from position ``at``: plain columns, so it is compiled."""
    return F.xxhash64(*[F.expr(f"get({words}, {at} + {i})") for i in range(length)])


def benchmark_windows(benchmark: DataFrame, text: str = "text", item_id: str = "item_id", window: int = WINDOW) -> DataFrame:
    """(length, key, gram, items): distinct windows of the benchmark and the items that hold them.

    Items without words have none; shorter items are one window.  Items with a
    null id count under the id null, which is left out of ``items``.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("w")).where("size(w) > 0")
    grams = items.select("item", F.expr(f"least(size(w), {window})").alias("length"), "w").select(
        "item", "length", F.explode(F.expr("transform(sequence(0, size(w) - length), i -> slice(w, i + 1, length))")).alias("gram")
    )
    # A short gram is hashed like a long one whose further words are missing: nulls leave the hash as it is.
    key = F.xxhash64(*[F.expr(f"get(gram, {i})") for i in range(window)])
    return grams.groupBy("length", "gram").agg(F.collect_set("item").alias("items")).withColumn("key", key)


def contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Every row of ``docs`` with ``_dwords``, ``_dspans``, ``_dhit`` and ``_ditems``.

    The benchmark's distinct windows are measured first; only below
    ``broadcast_bytes`` are they broadcast as a hash set, otherwise the windows
    of the documents are shuffled to their hashes, each as place and hash alone,
    and only stretches with a hash in common are fetched again to be compared.
    Each word position of a whole text is hashed once per window length that the
    benchmark has (ten at most), looked up, and compared word by word.  Texts of
    any length are taken in stretches of STRETCH words and the few after them.
    With a broadcast, positions without a hit end in the task that made them,
    so only hits are shuffled.  Rows are known by id, hash
    and length of the text: repeated rows share one result.  Null text has no
    words; an empty benchmark hits nothing.
    """
    grams = benchmark_windows(benchmark, window=window)
    lengths, size = {}, 0
    for r in grams.groupBy("length").agg(F.sum(F.length(F.concat_ws(",", "gram")) + F.length(F.concat_ws(",", "items")) + 64).alias("b")).collect():
        lengths[r["length"]] = r["b"]  # at most ``window`` rows
        size += r["b"]
    body = present(F.col(text))
    rid = F.struct(F.col(doc_id).isNull().alias("z"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("i"), F.xxhash64(body).alias("h"), F.length(body).alias("l"))
    rows = docs.withColumn("_drow", rid).withColumn("_dw", words_of(F.col(text)))
    counted = rows.withColumn("_dwords", F.size("_dw").cast("long")).drop("_dw")
    if not lengths:
        return counted.select(
            *[F.col(f"`{c}`") for c in docs.columns], "_dwords", F.expr("cast(array() as array<struct<s:int,e:int>>)").alias("_dspans"),
            F.lit(0).cast("long").alias("_dhit"), F.expr("cast(array() as array<string>)").alias("_ditems"),
        )
    cut = f"transform(sequence(0, greatest(size(_dw) - 1, 0) div {STRETCH}), c -> struct(int(c * {STRETCH}) AS base, slice(_dw, int(c * {STRETCH} + 1), {STRETCH + window - 1}) AS w))"
    parts = rows.select("_drow", F.inline(F.expr(cut)))
    tried = [F.struct(F.lit(n).alias("length"), _key("w", "at", n).alias("key")) for n in sorted(lengths)]
    at = parts.select("_drow", "base", "w", F.posexplode(F.slice("w", 1, STRETCH)).alias("at", "word"))
    at = at.select("_drow", "base", "w", "at", (tried[0] if len(tried) == 1 else F.explode(F.array(*tried))).alias("t"))
    at = at.select("_drow", "base", "w", "at", F.col("t.length").alias("length"), F.col("t.key").alias("key")).where("at + length <= size(w)")
    if size > broadcast_bytes:
        known = at.drop("w").join(grams.select("key", "length").distinct(), ["key", "length"], "left_semi").distinct()
        known = written(known, "window-places")
        fetched = parts.join(known.select("_drow", "base").distinct(), ["_drow", "base"], "left_semi").dropDuplicates(["_drow", "base"])
        at = known.join(fetched, ["_drow", "base"]).withColumn("gram", F.expr("slice(w, at + 1, length)")).drop("w")
        hits = at.join(grams, ["key", "length", "gram"])
    else:
        hits = at.join(F.broadcast(grams), ["key", "length"]).where("slice(w, at + 1, length) = gram")
    hits = hits.select("_drow", (F.col("base") + F.col("at")).alias("at"), "length", "items")
    merged = (
        hits.groupBy("_drow")
        .agg(F.array_sort(F.collect_set(F.struct(F.col("at").alias("s"), (F.col("at") + F.col("length")).alias("e")))).alias("_dspans"), F.collect_set("items").alias("sets"))
        .select("_drow", "_dspans", F.array_sort(F.array_distinct(F.flatten("sets"))).alias("_ditems"))
        .withColumn(
            "_dhit",
            F.expr(
                "aggregate(_dspans, struct(0L AS n, 0 AS e), (a, x) -> struct(a.n + greatest(0, x.e - greatest(a.e, x.s)) AS n, greatest(a.e, x.e) AS e), a -> a.n)"
            ),
        )
    )
    return (
        counted.join(merged, "_drow", "left")
        .withColumn("_dhit", F.coalesce("_dhit", F.lit(0).cast("long")))
        .withColumn("_ditems", F.coalesce("_ditems", F.expr("cast(array() as array<string>)")))
        .withColumn("_dspans", F.coalesce("_dspans", F.expr("cast(array() as array<struct<s:int,e:int>>)")))
        .drop("_drow")
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    return contamination(docs, benchmark, **options).select(
        "doc_id", F.col("_dwords").alias("n_words"), F.col("_dhit").alias("n_hit"), F.size("_ditems").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_ditems").cast("binary"), 256).alias("items_sha256"), (F.col("_dhit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` in which no benchmark window occurs."""
    return contamination(docs, benchmark, **options).where("_dhit = 0").select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All rows of ``docs``; the words inside hits are cut out of ``text``, what stands between words stays."""
    found = contamination(docs, benchmark, text=text, **options)
    body = present(F.col(text))
    pieces = F.regexp_extract_all(body, F.lit(f"{WORD}|{NOT_WORD}"), F.lit(0))
    first = F.when(body.rlike(f"^{NOT_WORD}"), 1).otherwise(0)
    kept = "filter(_dp, (x, i) -> (i + _df) % 2 = 1 OR NOT exists(_dspans, s -> s.s <= (i - _df) div 2 AND (i - _df) div 2 < s.e))"
    cut = found.withColumn("_dp", pieces).withColumn("_df", first).withColumn("_dcut", F.when(F.col("_dhit") > 0, F.concat_ws("", F.expr(kept))).otherwise(F.col(text)))
    return cut.select(*[(F.col("_dcut").alias(c) if c == text else F.col(f"`{c}`")) for c in docs.columns])
