"""Jaccard join of word n-gram sets: a prefix tree over globally ordered sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finecast.llm.components import components
from finecast.llm.shared import present, slices, written
from finecast.llm.tokens import mixed, shingles

WIDTH, PERCENT = 5, 80
#: Cells of the frequency sketch: a fixed size whatever the corpus; it orders tokens and decides no result.
CELL_BITS = 18
#: Up to this many sets, a token's sets are paired directly; beyond, by rounds of pivots.
FEW = 8
PIVOTS = 4
#: A cell of the sketch with so many times the mean count is hot: at most 2^CELL_BITS / HOT are.
HOT = 16
#: Sets of one tree.
TREE = 256
#: Up to this many candidate sets (a long each) their ids are broadcast to the texts; beyond, texts are shuffled to them.
BROADCAST_IDS = 2_000_000


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _texts(batch: pa.RecordBatch) -> list:
    return batch.column(batch.num_columns - 1).to_pylist()


def token_sketch(docs: DataFrame, width: int) -> np.ndarray:
    """How many sets hold a token of each cell, over all documents; 2^CELL_BITS numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CELL_BITS, np.int64)
        for b in slices(batches):
            np.add.at(total, _cells(np.concatenate([np.zeros(0, np.uint64), *(shingles(t, width) for t in _texts(b))])), 1)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(total[cell], pa.int64())], ["cell", "n"])

    rows = docs.select("body").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << CELL_BITS, np.int64)
    out[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return out


def ordered(tokens: np.ndarray, often: np.ndarray) -> np.ndarray:
    """A set in the global order: from the commonest cell to the rarest, then by number."""
    return tokens[np.lexsort((tokens, -often[_cells(tokens)]))]


def least(size, percent: int):
    """Smallest overlap with any set that is similar enough."""
    return -(-percent * size // 100)


def _described(docs: DataFrame, width: int, percent: int, often: np.ndarray) -> DataFrame:
    """(doc_id, n, a, b, rare): set size, 128-bit set hash, and the rarest tokens, one of which any partner shares."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, a, b, rare = [], [], [], []
            for t in _texts(batch):
                s = shingles(t, width)
                n.append(len(s))
                a.append(int(s.sum(dtype=np.uint64).astype(np.int64)) if len(s) else 0)
                b.append(int(np.bitwise_xor.reduce(mixed(s + np.uint64(len(s)))).astype(np.int64)) if len(s) else 0)
                rare.append(ordered(s, often)[least(len(s), percent) - 1 :].astype(np.int64) if len(s) else np.zeros(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in rare])]).astype(np.int32)
            values = np.concatenate(rare) if rare else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                ["doc_id", "n", "a", "b", "rare"],
            )

    return docs.select("doc_id", "body").mapInArrow(describe, "doc_id long, n long, a long, b long, rare array<long>")


def outline(tokens: np.ndarray) -> bytes:
    """How many tokens of a set fall into each of its cells, a byte each; empty if a cell holds too many.

    There are about four tokens to a cell, so it takes a twentieth of the set's room.
    """
    cells = max(64, 1 << max(0, len(tokens) // 4 - 1).bit_length())
    held = np.bincount((mixed(tokens) & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return held.astype(np.uint8).tobytes() if held.max(initial=0) < 256 else b""


def most_overlap(one: bytes, other: bytes) -> int | None:
    """What two sets can share at most by their outlines; the finer one is folded. None if an outline is missing."""
    if not one or not other:
        return None
    a, b = (np.frombuffer(x, np.uint8).astype(np.int64) for x in sorted((one, other), key=len))
    return int(np.minimum(a, b.reshape(-1, len(a)).sum(axis=0)).sum())


def _whole_sets(docs: DataFrame, width: int, often: np.ndarray) -> DataFrame:
    """(rep, n, outline, tokens): whole sets in the global order, as bytes, with size and outline."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [ordered(shingles(t, width), often) for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(r) for r in rows], pa.int64()), pa.array(list(map(outline, rows)), pa.binary()), pa.array([r.tobytes() for r in rows], pa.binary())],
                ["rep", "n", "outline", "tokens"],
            )

    return docs.select("rep", "body").mapInArrow(sets, "rep long, n long, outline binary, tokens binary")


def promising(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose outlines leave room for enough overlap, so that whole sets travel for few others.

    An outline's bound is never below the overlap, so no similar pair is lost.
    An id that stands for several sets is kept if any of them may do.
    """
    side = lambda c, n, o: sets.select(F.col("rep").alias(c), F.col("n").alias(n), F.col("outline").alias(o))
    rows = pairs.join(side("x", "n", "ox"), "x").join(side("y", "m", "oy"), "y").select("x", "y", "n", "m", "ox", "oy")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for x, y, n, m, ox, oy in zip(*(c.to_pylist() for c in b.columns), strict=True):
                most = most_overlap(ox, oy)
                if most is None or (100 + percent) * most >= percent * (n + m):
                    out.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], ["x", "y"])

    return rows.mapInArrow(keep, "x long, y long").distinct()


def tree_overlaps(pivot: np.ndarray, members: list[tuple[int, bytes]], percent: int) -> Iterator[tuple[int, int]]:
    """(id, overlap) of the members similar to the pivot.

    The members' ordered sets, sorted, are the paths of a prefix tree: each
    shares with the one before it a path whose overlap counts are kept, and only
    the rest is walked.  A subtree is left as soon as its overlap plus all that
    can still come is too small.
    """
    known = np.sort(pivot)
    path, counts = np.zeros(0, np.uint64), np.zeros(1, np.int64)
    for at, raw in sorted(members, key=lambda m: m[1]):
        own = np.frombuffer(raw, np.uint64)
        both = min(len(own), len(path))
        apart = np.flatnonzero(own[:both] != path[:both])
        shared = min(int(apart[0]) if len(apart) else both, len(counts) - 1)
        need = -(-percent * (len(own) + len(pivot)) // (100 + percent))
        counts, done, step = counts[: shared + 1], shared, 32
        while done < len(own):
            left = min(len(own) - done, len(pivot) - int(counts[-1]))
            if counts[-1] + left < need:
                break
            part = own[done : done + step]
            hit = known[np.minimum(np.searchsorted(known, part), len(known) - 1)] == part
            counts = np.concatenate([counts, counts[-1] + np.cumsum(hit)])
            done, step = done + len(part), step * 2
        path = own
        if done >= len(own) and counts[-1] >= need:
            yield at, int(counts[-1])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(x, y) of the pairs that are similar enough, by their whole sets.

    Pairs that their outlines rule out are dropped first.  A pivot x meets its partners in trees of bounded size: a pivot with more
    than TREE partners gets several, each with its own copy of x's set.
    """
    pairs = written(promising(pairs, sets, percent), "ngram-promising")
    sets = sets.select("rep", "tokens")
    trees = pairs.groupBy("x").agg(F.count("*").alias("m")).select("x", F.ceil(F.col("m") / TREE).alias("k"))
    dealt = pairs.join(trees, "x").select(F.col("y").alias("rep"), "x", F.pmod(F.xxhash64("y"), "k").cast("int").alias("tree"), "y")
    heads = trees.select(F.col("x").alias("rep"), "x", F.explode(F.expr("sequence(0, cast(k as int) - 1)")).alias("tree"), F.lit(None).cast("long").alias("y"))
    rows = (
        dealt.union(heads)
        .join(sets, "rep")
        .select("x", "tree", "y", "tokens")
        .repartition("x", "tree")
        .sortWithinPartitions("x", "tree", F.col("y").asc_nulls_first())
    )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pivots, members = None, [], []

        def similar() -> pa.RecordBatch:
            found = [y for p in pivots for y, _ in tree_overlaps(p, members, percent)]
            return pa.RecordBatch.from_arrays([pa.array([at[0]] * len(found), pa.int64()), pa.array(found, pa.int64())], ["x", "y"])

        for b in slices(batches):
            for x, tree, y, tokens in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (x, tree) != at:
                    if members:
                        yield similar()
                    at, pivots, members = (x, tree), [], []
                if y is None:
                    pivots.append(np.frombuffer(tokens, np.uint64))
                else:
                    members.append((y, tokens))
        if members:
            yield similar()

    return rows.mapInArrow(walk, "x long, y long")


def _lacking(percent: int) -> str:
    """How many tokens the prefixes of sets of n and m tokens have to share at least, if the sets are similar.

    All shared tokens up to the end of the shorter-reaching prefix stand in both
    prefixes; beyond it that set has less than its least overlap left.
    """
    least_of = lambda c: f"ceil({percent} * {c} / 100)"
    need = f"ceil({percent} * (n + m) / {100 + percent})"
    return f"({need} - greatest({least_of('n')}, {least_of('m')}) + 1)"


def _may_link(percent: int, common: str):
    """Whether sets of n and m tokens can be similar with ``common`` shared tokens in their prefixes at most."""
    return F.expr(f"100 * least(n, m) >= {percent} * greatest(n, m) AND {common} >= {_lacking(percent)}")


def _tested_once(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (x, y) that can be similar; the pivot stays first.

    ``c`` adds up over the tokens of few sets that state a pair, so it counts
    the prefix tokens of that kind which the two share; of tokens of many sets
    they share h at most, the smaller of their numbers of such tokens.  What a
    pair needs is taken row by row, from the two sizes of that row: rows may
    state a pair in both directions, and a repeated id has several sizes.

    The first round states all pairs that share a token of few sets, each with
    all of them, and so decides these pairs; later rounds count none of them.
    """
    one = pairs.groupBy(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).agg(
        F.min("x").alias("x"), F.sum("c").alias("c"), F.max("h").alias("h"), F.min(F.expr(_lacking(percent))).alias("lacking")
    )
    return one.where("c + h >= lacking").select("x", F.expr("lo + hi - x").alias("y"))


_PAIR = ("x", "y", "c", "h", "n", "m")


def similar_sets(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, links): one row per document, and links between class representatives.

    rows: (doc_id, n, rep, component); rep is the smallest id with the same set,
    component the smallest id reachable by links.  links: (x, y), enough of the
    similar pairs to join every component (pairs of sets already joined are not
    looked at).  Two sets are similar when 100 * overlap >= percent * union.

    Equal sets collapse by size and 128-bit hash.  Tokens are ordered from
    common to rare by a sketch of fixed size over all documents; a set's rarest
    tokens are its prefix, and similar sets share one.  Tokens that stand in one
    prefix only are dropped.  A token of few sets pairs them; one of many sets
    pairs a few pivots with all, in rounds with new pivots from those not yet
    joined to the largest component, while that joins most; whoever is left then
    is a query against all of the token's other components.  Pairs whose prefixes
    share too little are dropped by a bound that no similar pair breaks.  So no pair between
    components is left unseen, and no group is paired within itself.  Pairs are
    checked over whole sets by ``tree_overlaps``.

    Null and empty texts have n = 0, and rep and component of their own.  Rows
    with a null id have a class and a component if a row with an id is in it,
    else null.  Repeated ids with different texts are linked as one.
    """
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), present(F.col(text)).cast("binary").alias("body"))
    often = token_sketch(body, width)
    described = _described(body, width, percent, often)
    rows = written(described.drop("rare"), "ngram-sets")
    key = ["n", "a", "b"]
    # Described once more rather than kept: prefixes are the bulk of it.
    classes = written(described.where("n > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("rare").alias("rare")), "ngram-classes")
    # A repeated id may stand for several sets: all of them are looked at under its name.
    groups = _shared(classes.select("rep", "n", F.explode("rare").alias("token")), often)
    # g: prefix tokens that a set shares with any other, h: those of many sets.
    own = Window.partitionBy("rep")
    groups = written(
        groups.select("*", F.count("*").over(own).alias("g"), F.count_if(F.col("c") > FEW).over(own).alias("h")), "ngram-groups"
    )
    few = groups.where(f"c <= {FEW}").groupBy("token").agg(F.collect_list(F.struct("rep", "n", "g", "h")).alias("all"))
    one = few.select("all", F.explode("all").alias("p")).select("p", F.explode("all").alias("q")).where("p.rep < q.rep")
    pairs = one.selectExpr("p.rep AS x", "q.rep AS y", "1 AS c", "least(p.h, q.h) AS h", "p.n AS n", "q.n AS m", "least(p.g, q.g) AS g")
    pairs = pairs.where(_may_link(percent, "g")).select(*_PAIR)
    many = groups.where(f"c > {FEW}")
    tested = written(_tested_once(pairs.union(_star(many, percent, 0)), percent), "ngram-pairs")
    sets = _sets_of(tested, body, width, often, None)
    links = written(verified(tested, sets, percent), "ngram-links")
    comps = written(components(links, "x", "y"), "ngram-components")
    last, turn = None, 0
    while not many.isEmpty():
        turn += 1
        joined = many.join(comps.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep")).drop("component")
        sizes = joined.groupBy("token", "comp").agg(F.count("*").alias("k"))
        largest = sizes.groupBy("token").agg(F.max(F.struct("k", "comp")).alias("top"), F.count("*").alias("parts")).where("parts > 1").select("token", F.col("top.comp").alias("top"))
        joined = written(joined.join(largest, "token"), "ngram-open")
        left = joined.where("comp <> top").select("rep").distinct().count()
        if not left:
            break
        final = last is not None and 2 * left > last
        new = _rest(joined, percent) if final else _star(joined, percent, turn)
        both = tested.select("x", "y").union(tested.select(F.col("y").alias("x"), F.col("x").alias("y")))
        new = written(_tested_once(new, percent).join(both, ["x", "y"], "left_anti"), "ngram-pairs")
        sets = _sets_of(new, body, width, often, sets)
        links = links.union(written(verified(new, sets, percent), "ngram-links"))
        tested, last = tested.union(new), left
        comps = written(components(links, "x", "y"), "ngram-components")
        if final:
            break
    named = rows.join(classes.select(*key, "rep"), key, "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
    out = named.select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"), F.coalesce("component", "rep", "doc_id").alias("component"))
    return out, links


def _shared(tokens: DataFrame, often: np.ndarray) -> DataFrame:
    """(token, rep, n, c) of the tokens that c > 1 sets hold.

    Most are counted beside each other after one shuffle.  Those in a cell of the
    sketch that is HOT times as full as the mean, the only ones that many sets
    can hold, are counted map-side and joined back, which adaptive execution
    splits.  The list of such cells is bounded by the sketch's size.
    """
    hot = np.flatnonzero(often > HOT * often.mean())
    cells = tokens.sparkSession.createDataFrame([(int(c),) for c in hot], "cell int")
    cell = F.shiftrightunsigned("token", 64 - CELL_BITS).cast("int")
    marked = tokens.withColumn("cell", cell).join(F.broadcast(cells.withColumn("hot", F.lit(True))), "cell", "left").drop("cell")
    cold = marked.where("hot IS NULL").drop("hot").withColumn("c", F.count("*").over(Window.partitionBy("token"))).where("c > 1")
    full = marked.where("hot").drop("hot")
    counts = full.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    return cold.select("token", "rep", "n", "c").union(full.join(counts, "token").select("token", "rep", "n", "c"))


def _sets_of(pairs: DataFrame, body: DataFrame, width: int, often: np.ndarray, known: DataFrame | None) -> DataFrame:
    """Whole sets of all documents of ``pairs``, besides those already ``known``."""
    ids = pairs.select(F.col("x").alias("rep")).union(pairs.select("y")).distinct()
    ids = written(ids if known is None else ids.join(known.select("rep"), "rep", "left_anti"), "ngram-ids")
    near = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    sets = written(_whole_sets(body.withColumnRenamed("doc_id", "rep").join(near, "rep"), width, often), "ngram-whole")
    return sets if known is None else known.union(sets)


def _star(groups: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs of a few pivots of each token with all its sets.

    After the first round, pivots come from outside the token's largest component.
    """
    first = turn == 0
    comp = F.lit(None).cast("long") if first else F.col("comp")
    # Half of the pivots are those with the fewest prefix tokens of their own: whoever is
    # near to anything in a group of copies is near to the least changed one.  Half are drawn.
    own = F.expr(f"n - ceil({percent} * n / 100) + 1 - g")
    lows = [
        F.min(
            F.struct(
                (own if i < PIVOTS // 2 else F.lit(0).cast("long")).alias("o"), F.xxhash64("rep", F.lit(turn * PIVOTS + i)).alias("s"),
                F.col("rep").alias("x"), "n", F.col("g").alias("g1"), F.col("h").alias("h1"), comp.alias("c1"),
            )
        ).alias(f"p{i}")
        for i in range(PIVOTS)
    ]
    pivots = (groups if first else groups.where("comp <> top")).groupBy("token").agg(*lows)
    pivots = pivots.select("token", F.explode(F.array(*[f"p{i}" for i in range(PIVOTS)])).alias("p")).select("token", "p.x", "p.n", "p.g1", "p.h1", "p.c1").distinct()
    return _against(groups, pivots, comp, percent)


def _rest(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of every set outside its token's largest component with all of the token's other components.

    A pair comes up at the first token that both hold, not at each of them, and
    with the number of tokens of many sets that they share.
    """
    held = groups.withColumn("held", F.collect_set("token").over(Window.partitionBy("rep")))
    queries = held.where("comp <> top").select(
        F.col("token").alias("t"), F.col("rep").alias("x"), "n", F.col("g").alias("g1"), F.col("comp").alias("c1"), F.col("held").alias("held1")
    )
    others = held.select("token", F.col("rep").alias("y"), F.col("n").alias("m"), F.col("g").alias("g2"), F.col("comp").alias("c2"), F.col("held").alias("held2"))
    shared = F.array_intersect("held1", "held2")
    apart = F.expr("x <> y AND c1 <> c2") & _may_link(percent, "least(g1, g2)")
    pairs = others.join(queries, (F.col("token") == F.col("t")) & apart & (F.array_min(shared) == F.col("token")))
    return pairs.select("x", "y", F.lit(0).alias("c"), F.size(shared).cast("long").alias("h"), "n", "m")


def _against(groups: DataFrame, some: DataFrame, comp, percent: int) -> DataFrame:
    others = groups.select("token", F.col("rep").alias("y"), F.col("n").alias("m"), F.col("g").alias("g2"), F.col("h").alias("h2"), comp.alias("c2"))
    apart = F.expr("x <> y AND (c1 IS NULL OR c1 <> c2)")
    pairs = others.join(some.withColumnRenamed("token", "t"), (F.col("token") == F.col("t")) & apart & _may_link(percent, "least(g1, g2)"))
    return pairs.select("x", "y", F.lit(0).alias("c"), F.least("h1", "h2").alias("h"), "n", "m")


def join_report(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    rows, _ = similar_sets(docs, width, percent)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` with the smallest id of their component; rows without words or id stay."""
    rows, _ = similar_sets(docs, **options)
    away = rows.where("doc_id <> component").select("doc_id").distinct()
    return docs.join(away, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
