"""Extremely randomised trees with several outputs, grown level by level with DataFrame aggregates.

All trees grow at once.  A row carries the node that it stands on in every tree
(1 at the root, 2n and 2n + 1 below n) and is written with them once a level;
rows are never shuffled or sampled.  Draws are hashes of seed, tree, node and
feature, so a fit is the same whatever the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finecast.session import materialise

NODE = "t int, node int, n long, mean array<double>, f int, cut double"


def draw(*parts) -> Column:
    """32 hex digits for a mixture of columns and plain values."""
    return F.md5(F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]).cast("binary"))


def uniform(*parts) -> Column:
    """Number from 0 to 1."""
    return F.conv(F.substring(draw(*parts), 1, 13), 16, 10).cast("double") / float(16**13)


@dataclass(frozen=True)
class ExtraTrees:
    """Nodes of all trees as one table; as many rows as trees and depth allow, whatever the training rows."""

    nodes: DataFrame
    trees: int
    features: tuple[str, ...]
    outputs: tuple[str, ...]

    def predict(self, df: DataFrame, names: Sequence[str]) -> DataFrame:
        """``df`` with the mean of the trees' leaves per output, as columns ``names``."""
        held = df.withColumn("_x", F.array(*[F.col(f"`{c}`").cast("double") for c in self.features]))
        held = held.withColumns({"_node": F.array_repeat(F.lit(1), self.trees), "_sum": F.array(*[F.lit(0.0)] * len(self.outputs))})
        levels = sorted(r[0] for r in self.nodes.select(_level(F.col("node"))).distinct().collect())
        for level in levels:
            slots = _slots(self.nodes.filter(_level(F.col("node")) == level), level, self.trees)
            held = held.withColumn("_slots", slots)

            def add(a: Column, t: Column, level: int) -> Column:
                return F.when(_is_leaf(t, level), F.zip_with(a, _slot(t, level)["mean"], lambda u, v: u + v)).otherwise(a)

            found = F.aggregate(F.sequence(F.lit(0), F.lit(self.trees - 1)), F.col("_sum"), lambda a, t: add(a, t, level))  # noqa: B023
            held = held.withColumn("_sum", found).withColumn("_node", _moved(level, self.trees)).drop("_slots")
        out = {n: F.col("_sum")[i] / self.trees for i, n in enumerate(names)}
        return held.withColumns(out).drop("_x", "_node", "_sum")

    def save(self, path: str) -> None:
        self.nodes.write.mode("overwrite").parquet(path)


def _level(node: Column) -> Column:
    return F.floor(F.log2(node.cast("double"))).cast("int")


def _slots(nodes: DataFrame, level: int, trees: int) -> Column:
    """The nodes of one level as array (tree) of array (place in the level): a single value for every row to look into."""
    per_tree = nodes.groupBy("t").agg(F.collect_list(F.struct("node", "f", "cut", "mean")).alias("e"))
    first = 2**level
    dense = F.transform(F.sequence(F.lit(first), F.lit(2 * first - 1)), lambda i: F.get(F.filter("e", lambda e: e["node"] == i), F.lit(0)))
    table = per_tree.select("t", dense.alias("s")).agg(F.map_from_entries(F.collect_list(F.struct("t", "s"))).alias("m"))
    return table.select(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.element_at("m", t))).scalar()


def _slot(t: Column, level: int) -> Column:
    """The node that a row stands on in tree ``t``, if it is on this level."""
    return F.get(F.get(F.col("_slots"), t), F.get(F.col("_node"), t) - 2**level)


def _is_leaf(t: Column, level: int) -> Column:
    s = _slot(t, level)
    return (F.get(F.col("_node"), t) >= 2**level) & s.isNotNull() & s["f"].isNull()


def _moved(level: int, trees: int) -> Column:
    """Nodes after this level; -1 where the tree has ended."""
    def step(t: Column) -> Column:
        s, node = _slot(t, level), F.get(F.col("_node"), t)
        right = F.when(F.get(F.col("_x"), s["f"]) > s["cut"], 1).otherwise(0)
        return F.when((node < 2**level) | s.isNull() | s["f"].isNull(), -1).otherwise(node * 2 + right)

    return F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), step)


def fit(
    train: DataFrame, features: Sequence[str], outputs: Sequence[str], trees: int = 100, depth: int = 8, leaf: int = 5, tried: int | None = None, seed: int = 42
) -> ExtraTrees:
    """Grow ``trees`` on all rows of ``train``; features and outputs are complete and finite.

    A node draws its features in the order of their hash and tries the first
    ``tried`` (the root of their number) that vary among its rows, looking at
    twice as many at most.  Each gets one cut, uniform between its extremes in
    the node; rows up to the cut go left.  The cut with the largest sum over the
    outputs of squared sums by counts wins, the first of equals; both sides keep
    ``leaf`` rows at least.  Per level two aggregates by (tree, node): extremes
    of the drawn features, then counts and sums on the left of each cut.
    """
    d, m = len(features), len(outputs)
    k = tried or max(1, int(d**0.5))
    looked = min(d, 2 * k)
    rows = materialise(
        train.select(F.array(*[F.col(f"`{c}`").cast("double") for c in features]).alias("_x"), F.array(*[F.col(f"`{c}`").cast("double") for c in outputs]).alias("_y")), "tree-rows"
    )
    state = rows.withColumn("_node", F.array_repeat(F.lit(1), trees))
    opened = train.sparkSession.range(trees).select(F.col("id").cast("int").alias("t"), F.lit(1).alias("node"))
    made = []
    for level in range(depth + 1):
        each = state.select("_x", "_y", F.posexplode("_node").alias("t", "node")).filter("node > 0")
        mean = F.array(*[F.col(f"s{o}") / F.col("n") for o in range(m)]).alias("mean")
        totals = [F.count(F.lit(1)).alias("n"), *[F.sum(F.col("_y")[o]).alias(f"s{o}") for o in range(m)]]
        if level == depth:
            done = each.groupBy("t", "node").agg(*totals).select("t", "node", "n", mean, F.lit(None).cast("int").alias("f"), F.lit(None).cast("double").alias("cut"))
            made.append(materialise(done, "tree-level"))
            break
        order = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda i: F.struct(draw(seed, F.col("t"), F.col("node"), i).alias("h"), i.alias("i"))))
        drawn = opened.select("t", "node", F.slice(F.transform(order, lambda s: s["i"]), 1, looked).alias("drawn"))
        x = lambda i: F.get(F.col("_x"), i)
        ends = [g(x(F.col("drawn")[j])).alias(f"{n}{j}") for j in range(looked) for n, g in (("lo", F.min), ("hi", F.max))]
        ranges = each.join(drawn, ["t", "node"]).groupBy("t", "node", "drawn").agg(*ends)
        options = F.array(*[F.struct(F.col("drawn")[j].alias("f"), F.col(f"lo{j}").alias("lo"), F.col(f"hi{j}").alias("hi")) for j in range(looked)])
        varied = F.slice(F.filter(options, lambda o: o["lo"] < o["hi"]), 1, k)
        cut = lambda o: o["lo"] + uniform(seed, F.col("t"), F.col("node"), o["f"], "cut") * (o["hi"] - o["lo"])
        cuts = materialise(ranges.select("t", "node", F.transform(varied, lambda o: F.struct(o["f"].alias("f"), cut(o).alias("cut"))).alias("c")), "tree-cuts")
        option = [F.get(F.col("c"), F.lit(j)) for j in range(k)]
        left = [F.coalesce(x(o["f"]) <= o["cut"], F.lit(False)) for o in option]
        sides = [
            c for j in range(k) for c in (F.count_if(left[j]).alias(f"n{j}"), *[F.sum(F.when(left[j], F.col("_y")[o]).otherwise(0.0)).alias(f"s{j}_{o}") for o in range(m)])
        ]
        squares = F.sum(reduce(lambda a, b: a + b, [F.col("_y")[o] * F.col("_y")[o] for o in range(m)])).alias("q")
        stats = each.join(cuts, ["t", "node"]).groupBy("t", "node", "c").agg(*totals, squares, *sides)
        plus = lambda terms: reduce(lambda a, b: a + b, terms)
        split = []
        for j in range(k):
            nl, nr = F.col(f"n{j}"), F.col("n") - F.col(f"n{j}")
            gain = plus([F.try_divide(F.col(f"s{j}_{o}") * F.col(f"s{j}_{o}"), nl) + F.try_divide((F.col(f"s{o}") - F.col(f"s{j}_{o}")) * (F.col(f"s{o}") - F.col(f"s{j}_{o}")), nr) for o in range(m)])
            split.append(F.when((nl >= leaf) & (nr >= leaf), F.struct(gain.alias("gain"), F.lit(-j).alias("j"))))
        whole = plus([F.col(f"s{o}") * F.col(f"s{o}") for o in range(m)]) / F.col("n")
        # Rows alike in all outputs are a leaf.
        best = F.when(F.col("q") - whole > F.col("q") * 1e-12, F.array_max(F.array_compact(F.array(*split))))
        won = F.get(F.col("c"), -F.col("b.j"))
        result = materialise(stats.withColumn("b", best).select("t", "node", "n", mean, won["f"].alias("f"), won["cut"].alias("cut")), "tree-level")
        made.append(result)
        opened = result.filter("f is not null").select("t", F.explode(F.array(F.col("node") * 2, F.col("node") * 2 + 1)).alias("node"))
        if opened.isEmpty():
            break
        state = materialise(state.withColumn("_slots", _slots(result, level, trees)).withColumn("_node", _moved(level, trees)).drop("_slots"), "tree-state")
    return ExtraTrees(reduce(DataFrame.unionByName, made), trees, tuple(features), tuple(outputs))


def load(spark, path: str, trees: int, features: Sequence[str], outputs: Sequence[str]) -> ExtraTrees:
    return ExtraTrees(spark.read.schema(NODE).parquet(path), trees, tuple(features), tuple(outputs))
