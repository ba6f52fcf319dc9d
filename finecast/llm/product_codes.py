"""Product codes of vectors: one codebook per part, refined by Lloyd rounds that look only where something moved."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finecast.llm.shared import slices, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Differences of integers, squared and summed over a vector, stay below this.
LARGEST = 1 << 62
#: Vectors that one pass in Python holds.
ROWS = 2048


@dataclass(frozen=True)
class Codebooks:
    """Entries of each part, (parts, entries, width), and which of them moved in the last round.

    The size is set by the parameters and the width of a vector, not by the rows.
    """

    entries: np.ndarray
    moved: np.ndarray

    def digits(self) -> str:
        """All integers by part, entry and place, joined by commas."""
        return ",".join(map(str, self.entries.ravel().tolist()))


def _exact(bound: int, width: int) -> type:
    """Doubles where sums of products stay below 2^53, else 64-bit integers."""
    return np.float64 if 4 * width * bound * bound < 1 << 53 else np.int64


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows and entries, exact."""
    bound = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)), 1)
    kind = _exact(bound, x.shape[1])
    x, c = x.astype(kind), c.astype(kind)
    return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)


def assign(x: np.ndarray, books: Codebooks, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry and exact distance of every part of the rows ``x`` (rows, parts, width); ties go to the lower index.

    ``near`` and ``far`` are entry and distance from the round before (-1: none).
    A part whose entry stayed where it was keeps an exact distance, and no
    entry that stayed can be nearer than before, so only entries that moved are
    compared, with an equal distance and a lower index counting as nearer.  Any
    other part looks at all entries.  Also returns how many distances were taken.
    """
    near, far, taken = near.copy(), far.copy(), 0
    for p in range(x.shape[1]):
        c, moved = books.entries[p], books.moved[p]
        again = (near[:, p] < 0) | moved[near[:, p]]
        rows = np.flatnonzero(again)
        if len(rows):
            d = _distances(x[rows, p], c)
            at = d.argmin(1)
            near[rows, p], far[rows, p] = at, d[np.arange(len(rows)), at]
            taken += d.size
        rows, active = np.flatnonzero(~again), np.flatnonzero(moved)
        if len(rows) and len(active):
            d = _distances(x[rows, p], c[active])
            best = d.argmin(1)
            at, d = active[best], d[np.arange(len(rows)), best]
            better = (d < far[rows, p]) | ((d == far[rows, p]) & (at < near[rows, p]))
            near[rows[better], p], far[rows[better], p] = at[better], d[better]
            taken += len(rows) * len(active)
    return near, far, taken


def _cells(column: pa.Array) -> np.ndarray:
    """Fixed-length lists of numbers as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _lists(m: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(m.ravel(), kind))


def _assigned(state: DataFrame, books: Codebooks) -> DataFrame:
    """``state`` after one more assignment."""
    parts = books.entries.shape[0]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, ROWS):
            x = _cells(b["v"]).astype(np.int64)
            near, far, _ = assign(x.reshape(len(x), parts, -1), books, _cells(b["near"]).astype(np.int64), _cells(b["far"]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([b["row"], b["v"], _lists(near, pa.int32()), _lists(far, pa.int64())], names=["row", "v", "near", "far"])

    return state.mapInArrow(step, state.schema)


def _sums(state: DataFrame, parts: int, entries: int) -> dict[tuple[int, int], tuple[int, np.ndarray]]:
    """Count and componentwise sum of the parts of each entry; added up by Spark, one row per used entry reaches the driver."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = total = None
        for b in slices(batches, ROWS):
            x = _cells(b["v"]).astype(np.int64)
            x, near = x.reshape(len(x), parts, -1), _cells(b["near"]).astype(np.int64)
            if total is None:
                count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, x.shape[2]), np.int64)
            for p in range(parts):
                np.add.at(total[p], near[:, p], x[:, p])
                count[p] += np.bincount(near[:, p], minlength=entries)
        if total is not None:
            p, e = np.nonzero(count)
            width = np.arange(total.shape[2])
            names = ["p", "e", "i", "n", "s"]
            cells = [np.repeat(p, len(width)), np.repeat(e, len(width)), np.tile(width, len(p)), np.repeat(count[p, e], len(width)), total[p, e].ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, [pa.int32()] * 3 + [pa.int64()] * 2, strict=True)], names=names)

    # Decimal sums: no number of rows makes them overflow.
    rows = (
        state.select("v", "near").mapInArrow(partial, "p int, e int, i int, n long, s long")
        .groupBy("p", "e", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
        .groupBy("p", "e").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "s"))).alias("s")).collect()
    )
    return {(r["p"], r["e"]): (r["n"], [int(x["s"]) for x in r["s"]]) for r in rows}


def _moved(books: Codebooks, sums: dict) -> Codebooks:
    """Every used entry at the floor of the mean of its parts; unused entries stay."""
    fresh = books.entries.copy()
    for (p, e), (n, s) in sums.items():
        fresh[p, e] = [x // n for x in s]
    return Codebooks(fresh, (fresh != books.entries).any(2))


def integers(df: DataFrame, vector: str, scale: int, kept: str = "_v") -> DataFrame:
    """Rows of ``df`` whose vector can be coded, with its components as integers floor(scale * x) under ``kept``.

    A vector that is null or holds a null or non-finite component goes; so does
    one with a component so large (about 2^27 / scale at 64 components) that 64
    bits could not hold its squared distances.
    """
    x = F.col(vector)
    bound = F.sqrt(F.lit(float(LARGEST // 4)) / F.greatest(F.size(x), F.lit(1)))
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v * scale) >= bound - 1)
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("int"))
    return df.where(x.isNotNull() & ~F.exists(x, lambda v: F.coalesce(bad(v.cast("double")), F.lit(True)))).withColumn(kept, whole)


def product_codes(
    df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, Codebooks]:
    """Rows of ``df`` that can be coded, with ``pq_code`` (array<int>) and ``pq_error`` (long), and the codebooks.

    Vectors become integers (``integers``) and are cut into ``parts`` equal
    consecutive parts.  The codebook of a part starts as that part of the
    ``entries`` smallest ids, ascending (ids that are null last, equal ids by
    vector); with fewer rows it is shorter.  Each round assigns all parts and
    moves every used entry to the floor of its parts' mean; after the last
    round all parts are assigned once more.

    The width is that of the smallest id's vector and must be a multiple of
    ``parts``; rows of another width go, and a width that can't be cut leaves
    no row.  Columns ``pq_code`` and ``pq_error`` of ``df`` are replaced, the
    vector, for which the code now stands, goes, all others stay.  Repeated rows
    are coded alike; an empty table gives no rows and empty codebooks.

    State (integers, entry and distance per part, a good third of the vectors'
    size) is written in the shared folder after each assignment: a lost executor
    costs a task, not a round, and rows never move between tasks.  Only sums per entry are shuffled, as many
    as the codebooks hold.
    """
    df = df.drop("pq_code", "pq_error")
    others = [c for c in df.columns if c != vector]
    none = T.StructType([*df.drop(vector).schema.fields, T.StructField("pq_code", T.ArrayType(T.IntegerType())), T.StructField("pq_error", T.LongType())])
    whole = integers(df, vector, scale)
    keyed = whole.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col("_v").alias("v"), F.col(vec_id).alias("_id"))
    state = written(keyed.select("row", "v", F.array(*[F.lit(-1)] * parts).alias("near"), F.array(*[F.lit(0).cast("long")] * parts).alias("far")), "codes")
    by_id = F.col(f"row.`{vec_id}`")
    first = state.select("v", by_id.alias("i")).orderBy(F.col("i").asc_nulls_last(), "v").limit(1).collect()
    width = len(first[0]["v"]) if first else 0
    if not width or width % parts:
        return df.sparkSession.createDataFrame([], none), Codebooks(np.zeros((parts, 0, 0), np.int64), np.zeros((parts, 0), bool))
    state = state.where(F.size("v") == width)
    start = state.select("v", by_id.alias("i")).orderBy(F.col("i").asc_nulls_last(), "v").limit(entries).collect()
    rows = np.array([r["v"] for r in start], np.int64).reshape(len(start), parts, width // parts)
    books = Codebooks(np.ascontiguousarray(rows.transpose(1, 0, 2)), np.ones((parts, len(start)), bool))
    for _ in range(rounds):
        state = written(_assigned(state, books), "codes")
        books = _moved(books, _sums(state, parts, len(start)))
    state = written(_assigned(state, books), "codes")
    error = F.aggregate("far", F.lit(0).cast("long"), lambda t, d: t + d)
    return state.select("row.*", F.col("near").alias("pq_code"), error.alias("pq_error")), books


def rebuilt(codes: DataFrame, books: Codebooks, scale: int = SCALE, code: str = "pq_code", vector: str = "pq_vector") -> DataFrame:
    """``codes`` with the vector that each code stands for under ``vector``: middles of the integer cells, divided by ``scale``."""
    table = [[[(int(x) + 0.5) / scale for x in e] for e in part] for part in books.entries]
    cells = F.array(*[F.array(*[F.array(*[F.lit(x) for x in e]) for e in part]) for part in table])
    return codes.withColumn(vector, F.flatten(F.zip_with(cells, F.col(code), lambda part, e: part[e])))


def codes_report(vectors: DataFrame) -> DataFrame:
    """One row per kept vector: id, code in hex, error, error of its label, digest of the codebooks.

    Errors are added up per label before they meet the rows, so a label of any
    size is one row a task; null labels count as one label.
    """
    coded, books = product_codes(vectors.select("vec_id", "embedding", "label"))
    rows = coded.select(
        "vec_id", "label", F.array_join(F.transform("pq_code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"), F.col("pq_error").alias("error")
    )
    totals = rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return rows.join(totals, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.sha2(F.lit(books.digits()).cast("binary"), 256).alias("codebooks_sha256")
    )
