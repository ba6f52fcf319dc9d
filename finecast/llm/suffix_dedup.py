"""Repeated byte strings: maximal repeats from enhanced suffix arrays over anchored pieces of text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finecast.llm.shared import present, slices, written
from finecast.llm.tokens import _BYTE, _power, mixed

LENGTH = 100
#: Bytes of an anchor; every string of LENGTH bytes holds one, at a place that depends on the string alone.
ANCHOR = 16
#: Pieces of one anchor that meet in one suffix array; more are compared string by string, by grouping.
PIECES = 4096
#: Bytes of text of one suffix array.
ARRAY_BYTES = 1 << 19


def pieces(text: bytes, length: int) -> tuple[np.ndarray, ...]:
    """(key, print, start, last) of the pieces of a text.

    A string of ``length`` bytes belongs to the anchor with the smallest hash in
    it (the leftmost of equals).  Strings that start at ``start`` to ``last``
    share an anchor and make one piece, the bytes from ``start`` to
    ``last + length``.  ``key`` is the anchor's hash, ``print`` one of all bytes.
    """
    n = len(text)
    if n < length:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    word = np.ndarray((n - 7,), "<u8", text, 0, (1,))
    hashed = mixed(mixed(word[:-8] * np.uint64(0x9E3779B97F4A7C15)) + word[8:])
    low = (hashed & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashed), dtype=np.uint64)
    span, wide = 1, length - ANCHOR + 1
    while span * 2 <= wide:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if wide > span:
        low = np.minimum(low[: len(low) - (wide - span)], low[wide - span :])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    turn = np.flatnonzero(at[1:] != at[:-1])
    start = np.concatenate([[0], turn + 1])
    last = np.concatenate([turn, [len(at) - 1]])
    return hashed[at[start]], prints(text, start, last + length), start, last


def prints(text: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of text[start:end]."""
    up, down = _power(len(text) + 1)
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_BYTE[np.frombuffer(text, np.uint8)] * up[: len(text)], out=total[1:])
    return mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def suffixes(texts: list[bytes], starts: list[int], length: int) -> tuple[np.ndarray, ...]:
    """(text, place, lcp, before): enhanced suffix array of the strings that start in the first ``starts[i]`` bytes of texts.

    Suffixes are sorted as big-endian words; ``lcp[i]`` is what suffix i shares
    with the one after it, ``before`` the byte to its left (-1 at the left end).
    Strings whose first ``length`` bytes stand alone by their hash are no repeats
    and are left out before sorting.
    """
    size = np.array([len(t) for t in texts])
    words = int(-(-size.max() // 8)) if len(size) else 0
    grid = np.zeros((len(texts), words * 8 + 8), np.uint8)
    for i, t in enumerate(texts):
        grid[i, : len(t)] = np.frombuffer(t, np.uint8)
    count = np.array(starts)
    text = np.repeat(np.arange(len(texts)), count)
    place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    base = np.ndarray((len(texts), words * 8 + 1), ">u8", grid, 0, (grid.shape[1], 1))
    look = np.zeros(len(text), np.uint64)
    for k in [*range(0, length - 7, 8), length - 8]:
        look = mixed(look * np.uint64(0x9E3779B97F4A7C15) + base[text, place + k].astype(np.uint64))
    _, back, seen = np.unique(look, return_inverse=True, return_counts=True)
    again = seen[back] > 1
    text, place = text[again], place[again]
    left = size[text] - place
    keys = np.zeros((len(text), words), np.uint64)
    for k in range(words):
        keys[:, k] = np.where(8 * k < left, base[text, np.minimum(place + 8 * k, words * 8)], 0)
    order = np.lexsort([left, *keys.T[::-1]])
    text, place, left, keys = text[order], place[order], left[order], keys[order]
    differ = keys[1:] != keys[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), words - 1) if len(differ) else np.zeros(0, np.int64)
    row = np.arange(len(first))
    apart = keys[1:][row, first] ^ keys[:-1][row, first]
    same = np.zeros(len(first), np.int64)
    for byte in range(8):  # equal leading bytes of the first differing word
        same += (apart >> np.uint64(56 - 8 * byte)) == 0
    lcp = np.minimum(8 * first + same, np.minimum(left[1:], left[:-1]))
    before = np.where(place > 0, grid[text, np.maximum(place - 1, 0)].astype(np.int64), -1)
    return text, place, lcp, before


def interval_tree(lcp: np.ndarray, before: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(common, lo, hi) of the maximal repeats, inner intervals before outer ones.

    One scan of the common prefixes with a stack of open intervals.  An interval
    is a maximal repeat when the bytes to the left of its members differ, or one
    of them stands at the left end of its text.
    """
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []
    for i in range(1, len(before) + 1):
        here = int(lcp[i - 1]) if i < len(before) else 0
        here = here if here >= length else 0
        lo = i - 1
        while stack and stack[-1][0] > here:
            common, lo = stack.pop()
            part = before[lo:i]
            if (part < 0).any() or (part != part[0]).any():
                found.append((common, lo, i - 1))
        if here and (not stack or stack[-1][0] < here):
            stack.append((here, lo))
    return found


def maximal_repeats(texts: list[bytes], starts: list[int], length: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(length, all occurrences as (text, place)) of the maximal repeats of at least ``length`` bytes within ``texts``."""
    text, place, lcp, before = suffixes(texts, starts, length)
    for common, lo, hi in interval_tree(lcp, before, length):
        yield common, list(zip(text[lo : hi + 1].tolist(), place[lo : hi + 1].tolist(), strict=True))


def _numbered(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc, copy, body): rows of one id are copies 0, 1, ... in the order of their texts; a null id is the last id."""
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)).alias("doc"), present(F.col(text)).cast("binary").alias("body"))
    if rows.groupBy("doc").count().where("count > 1").isEmpty():
        return rows.withColumn("copy", F.lit(0))
    return rows.withColumn("copy", F.row_number().over(Window.partitionBy("doc").orderBy("body")) - 1)


def _piece_rows(docs: DataFrame, length: int) -> DataFrame:
    """(part, key, print, doc, copy, start, n, again): one row per piece; those with an equal, earlier one in their task have part > 0, and that one has again."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[tuple[np.ndarray, ...]] = []
        for b in slices(batches):
            for doc, copy, body in zip(*(c.to_pylist() for c in b.columns), strict=True):
                key, mark, start, last = pieces(body, length)
                if len(key):
                    got.append((key, mark, np.full(len(key), doc, np.int64), np.full(len(key), copy, np.int32), start.astype(np.int32), (last - start + 1).astype(np.int32)))
        if not got:
            return
        key, mark, doc, copy, start, n = (np.concatenate(c) for c in zip(*got, strict=True))
        del got
        if (np.diff(doc) < 0).any() or (np.diff(copy) != 0).any():
            order = np.lexsort((start, copy, doc))
            key, mark, doc, copy, start, n = (c[order] for c in (key, mark, doc, copy, start, n))
        both = mixed(key + mixed(mark))
        order = np.argsort(both, kind="stable")
        later = np.zeros(len(key), bool)
        later[order[1:]] = both[order[1:]] == both[order[:-1]]
        again = np.zeros(len(key), bool)
        again[order[:-1]] = later[order[1:]]
        part = np.where(later, np.abs(doc) % 65521 + 1, 0).astype(np.int32)
        for at in range(0, len(key), 1 << 16):
            s = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[s]) for c in (part, key.view(np.int64), mark.view(np.int64), doc, copy, start, n, again)], ["part", "key", "print", "doc", "copy", "start", "n", "again"]
            )

    return docs.select("doc", "copy", "body").mapInArrow(cut, "part int, key long, print long, doc long, copy int, start int, n int, again boolean")


def repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(repeat, parent, doc, copy, start, size, gone): occurrences of repeated strings of at least ``length`` bytes.

    ``repeat`` names a string of ``size`` bytes.  Repeats form a tree: an
    occurrence stands once, under the longest repeat that starts there, and all
    occurrences of a repeat are its own and those of the repeats whose ``parent``
    it is, and so on down; a row without ``doc`` states a repeat's place in the
    tree.  ``gone`` is the length of the longest string that starts there and
    also starts earlier (by id, copy, place), 0 if none does.  Texts are cut into pieces around anchors, so that equal
    strings of ``length`` bytes always fall into pieces of one key: the
    repeats of a key's pieces are all there are, and a longer repeat shows as
    overlapping repeats of neighbouring keys.

    1. Equal pieces (key and print, 128 bits) are repeats as they are.  Those of
       one task are told apart before the shuffle, so copies of a document cost
       a row per task and key.
    2. Of different pieces with one key, one of each kind is fetched from its
       text, and the maximal repeats among them come from an enhanced suffix
       array (``maximal_repeats``).  A key with more than PIECES kinds (the edge
       of a very common passage) is taken string by string instead: grouped by
       hash with the earliest combined map-side.

    Copies of a piece stand wherever the fetched one of their kind does; a
    repeat that is a whole piece hangs below the repeat that starts with it.  Under
    a key with more than PIECES kinds, groups are complete for strings of ``length`` bytes only.

    Matches never cross documents.  Null text is empty; texts shorter than
    ``length`` have no repeats.
    """
    kinds, whole, parts = _found_repeats(docs, length, text, doc_id)
    parts = written(parts, "repeats")
    copies = kinds.where("later").select("key", "print", F.col("doc").alias("cd"), F.col("copy").alias("cc"), F.col("start").alias("cs"), (F.col("n") + length - 1).alias("cn"))
    fetched = kinds.where("mixed AND NOT later").select("key", "print", "doc", "copy", F.col("start").alias("piece"))
    inner = parts.where("doc IS NOT NULL").join(fetched, ["key", "doc", "copy", "piece"]).withColumn("place", F.col("start") - F.col("piece"))
    more = inner.where("place > 0").join(copies, ["key", "print"]).select(
        "repeat", "parent", F.col("cd").alias("doc"), F.col("cc").alias("copy"), (F.col("cs") + F.col("place")).alias("start"), "size", (F.col("cn") - F.col("place")).alias("gone")
    )
    heads = inner.where("place = 0").select("key", "print", F.col("repeat").alias("head"), F.col("parent").alias("above"), F.col("size").alias("long"))
    same = F.col("long") == F.col("size")
    linked = whole.join(heads, ["key", "print"], "left").select(
        F.when(same, F.col("head")).otherwise(F.col("repeat")).alias("repeat"), F.when(same, F.col("above")).otherwise(F.col("head")).alias("parent"), "doc", "copy", "start", "size", "gone"
    )
    return linked.union(parts.select(*_REPEAT)).union(more)


_REPEAT = ("repeat", "parent", "doc", "copy", "start", "size", "gone")


def _found_repeats(docs: DataFrame, length: int, text: str, doc_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kinds, whole, parts): pieces that are repeated or share a key, repeats that are whole pieces, and those among the fetched pieces."""
    docs = _numbered(docs, text, doc_id)
    w = Window.partitionBy("part", "key")
    first = w.orderBy("print", "doc", "copy", "start")
    kinds = (
        _piece_rows(docs, length)
        .withColumn("later", (F.col("part") > 0) | F.coalesce(F.lag("print").over(first) == F.col("print"), F.lit(False)))
        .withColumn("shown", F.col("again") | F.coalesce(F.lead("print").over(first) == F.col("print"), F.lit(False)))
        .withColumn("mixed", F.min("print").over(w) != F.max("print").over(w))
        .withColumn("held", F.count("*").over(w))
        .where("later OR shown OR mixed")
        .drop("part", "again")
    )
    kinds = written(kinds, "pieces")
    whole = kinds.where("later OR shown").select(
        F.xxhash64("key", "print").alias("repeat"), F.lit(None).cast("long").alias("parent"), "doc", "copy", "start", (F.col("n") + length - 1).alias("size"),
        F.when(F.col("later"), F.col("n") + length - 1).otherwise(0).alias("gone"), "key", "print",
    )
    asked = kinds.where("mixed AND NOT later").select("doc", "copy", "key", "start", "n", "held")
    spots = asked.groupBy("doc", "copy").agg(F.collect_list(F.struct("key", "start", "n", "held")).alias("spots"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = [], [], [], [], [], []
            for doc, copy, body, spots in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for s in spots:
                    few = s["held"] <= PIECES
                    for c, v in zip(out, (s["key"], doc, copy, s["start"], s["n"] if few else -s["n"], body[s["start"] : s["start"] + s["n"] + length - 1]), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()), strict=True)], ["key", "doc", "copy", "start", "n", "piece"])

    fetched = docs.join(spots, ["doc", "copy"]).select("doc", "copy", "body", "spots").mapInArrow(fetch, "key long, doc long, copy int, start int, n int, piece binary")
    fetched = written(fetched, "fetched")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def found() -> pa.RecordBatch:
            texts = [h[5] for h in held]
            text, place, lcp, before = suffixes(texts, [h[4] for h in held], length)
            tree = interval_tree(lcp, before, length)
            n = len(text)
            doc, copy = (np.array([h[k] for h in held], np.int64)[text] for k in (1, 2))
            key, piece = (np.array([h[k] for h in held], np.int64)[text] for k in (0, 3))
            start = piece + place
            age = np.empty(n, np.int64)
            age[np.lexsort((start, copy, doc))] = np.arange(n)
            own, gone = np.full(n, -1), np.zeros(n, np.int64)
            above = []
            for k in range(len(tree) - 1, -1, -1):  # outer intervals first; inner ones are longer and overwrite
                common, lo, hi = tree[k]
                above.append(int(own[lo]))
                own[lo : hi + 1] = k
                first = lo + int(age[lo : hi + 1].argmin())
                kept = gone[first]
                gone[lo : hi + 1] = common
                gone[first] = kept
            above.reverse()
            names = [int.from_bytes(hashlib.blake2b(texts[text[lo]][place[lo] : place[lo] + common], digest_size=8).digest(), "little", signed=True) for common, lo, _ in tree]
            size_of = [common for common, _, _ in tree]
            at = np.flatnonzero(own >= 0)
            node = [names[k] if k >= 0 else None for k in above]
            none = [None] * len(tree)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(names + [names[k] for k in own[at]], pa.int64()), pa.array(node + [node[k] for k in own[at]], pa.int64()),
                    pa.array(none + doc[at].tolist(), pa.int64()), pa.array(none + copy[at].tolist(), pa.int32()), pa.array(none + start[at].tolist(), pa.int32()),
                    pa.array(size_of + [size_of[k] for k in own[at]], pa.int32()), pa.array([0] * len(tree) + gone[at].tolist(), pa.int32()),
                    pa.array(none + key[at].tolist(), pa.int64()), pa.array(none + piece[at].tolist(), pa.int32()),
                ],
                [*_REPEAT, "key", "piece"],
            )

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if size > ARRAY_BYTES and row[0] != held[-1][0]:
                    yield found()
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield found()

    few = fetched.where("n > 0").repartition("key").sortWithinPartitions("key").mapInArrow(scan, "repeat long, parent long, doc long, copy int, start int, size int, gone int, key long, piece int")

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, doc, copy, start, n, piece in zip(*(c.to_pylist() for c in b.columns), strict=True):
                at = np.arange(-n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints(piece, at, at + length).view(np.int64)), pa.array([hash_of(piece[i : i + length]) for i in at], pa.int64()), pa.array(np.full(-n, doc)), pa.array(np.full(-n, copy, np.int32)), pa.array((start + at).astype(np.int32)), pa.array(np.full(-n, key)), pa.array(np.full(-n, start, np.int32))],
                    ["a", "b", "doc", "copy", "start", "key", "piece"],
                )

    strings = fetched.where("n < 0").mapInArrow(single, "a long, b long, doc long, copy int, start int, key long, piece int")
    strings = written(strings, "strings")
    lows = strings.groupBy("a", "b").agg(F.min(F.struct("doc", "copy", "start")).alias("low"), F.count("*").alias("k")).where("k > 1")
    many = strings.join(lows, ["a", "b"]).select(
        F.xxhash64("a", "b").alias("repeat"), F.lit(None).cast("long").alias("parent"), "doc", "copy", "start", F.lit(length).alias("size"),
        F.when(F.struct("doc", "copy", "start") == F.col("low"), 0).otherwise(length).alias("gone"), "key", "piece",
    )
    return kinds, whole, few.union(many)


def hash_of(piece: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True)


def _cut(body: bytes, spans: list[tuple[int, int]]) -> tuple[int, list[tuple[int, int]], bytes]:
    """Removed bytes, maximal removed runs, and what remains."""
    runs: list[list[int]] = []
    for s, e in sorted(spans):
        if runs and s <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e)
        else:
            runs.append([s, e])
    kept, at = [], 0
    for s, e in runs:
        kept.append(body[at:s])
        at = e
    kept.append(body[at:])
    return sum(e - s for s, e in runs), [tuple(r) for r in runs], b"".join(kept)


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, copy, n_bytes, runs, kept): each row of ``docs`` without the bytes of repeated strings that also start earlier.

    ``runs`` are the maximal removed runs as (s, e); ``kept`` the remaining
    bytes, which need not be valid UTF-8.  Rows with one id are copies 0, 1, ...
    and count as later in that order.  An empty table gives no rows.
    """
    # Copies lose their pieces as a whole: where else they stand makes no difference.
    _, whole, parts = _found_repeats(docs, length, text, doc_id)
    again = whole.select(*_REPEAT).union(parts.select(*_REPEAT)).where("gone > 0")
    spans = again.groupBy("doc", "copy").agg(F.collect_list(F.struct(F.col("start").alias("s"), (F.col("start") + F.col("gone")).alias("e"))).alias("spans"))
    rows = _numbered(docs, text, doc_id).join(spans, ["doc", "copy"], "left").select("doc", "copy", "body", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            n, runs, kept = [], [], []
            for body, spans in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                _, r, rest = _cut(body, [(x["s"], x["e"]) for x in spans or ()])
                n.append(len(body))
                runs.append([{"s": s, "e": e} for s, e in r])
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(runs, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))), pa.array(kept, pa.binary())],
                ["doc", "copy", "n_bytes", "runs", "kept"],
            )

    out = rows.mapInArrow(cut, "doc long, copy int, n_bytes long, runs array<struct<s:int,e:int>>, kept binary")
    return out.select(F.when(F.col("doc") < (1 << 63) - 1, F.col("doc")).alias("doc_id"), "copy", "n_bytes", "runs", "kept")


def repeats_report(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", F.expr("aggregate(runs, 0L, (a, x) -> a + x.e - x.s)").alias("n_removed"), F.size("runs").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
