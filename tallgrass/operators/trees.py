"""A regression tree grown level by level from binned sums."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallgrass.plans.lineage import cut_lineage

#: Decimal places of a split's gain, as a share of the label's whole scatter; closer gains are ties.
PLACES = 9


@dataclass(frozen=True)
class Split:
    """Rows of ``node`` whose feature lies in a bin above ``bin`` go to node 2n + 1, the others to 2n."""

    node: int
    feature: int
    bin: int
    threshold: float
    gain: float


@dataclass(frozen=True)
class Tree:
    low: tuple[float, ...]
    high: tuple[float, ...]
    bins: int
    splits: Mapping[int, Split]
    means: Mapping[int, float]

    def leaf(self, features: str = "features") -> Column:
        """The leaf of a feature vector, as an expression."""
        return _leaf(_binned(features, self.low, self.high, self.bins), self.splits)

    def prediction(self, features: str = "features") -> Column:
        """The mean label of the training rows of the leaf; null for a tree without rows."""
        if not self.means:
            return F.lit(None).cast("double")
        means = F.create_map(*[F.lit(x) for pair in self.means.items() for x in pair])
        return means[self.leaf(features)]

    def importances(self) -> list[float]:
        """Share of each feature in the scatter that all splits take away; zeros without a split."""
        total = sum(s.gain for s in self.splits.values())
        parts = [sum(s.gain for s in self.splits.values() if s.feature == i) for i in range(len(self.low))]
        return [p / total if total else 0.0 for p in parts]


def _binned(features: str, low: tuple[float, ...], high: tuple[float, ...], bins: int) -> Column:
    x = vector_to_array(features)

    def place(i: int, a: float, b: float) -> Column:
        if not b > a:
            return F.lit(0)
        # unseen values beyond the ends belong to the end bins
        return F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((x[i] - a) * bins / (b - a)).cast("int")))

    return F.array(*[place(i, a, b) for i, (a, b) in enumerate(zip(low, high, strict=True))])


def _leaf(bins: Column, splits: Mapping[int, Split], node: int = 1) -> Column:
    if node not in splits:
        return F.lit(node)
    split = splits[node]
    above = _leaf(bins, splits, 2 * node + 1)
    return F.when(bins[split.feature] > split.bin, above).otherwise(_leaf(bins, splits, 2 * node))


def grow_tree(train: DataFrame, inputs: int, depth: int = 5, bins: int = 32) -> Tree:
    """The tree of (features, label) that takes away most squared error at each split.

    The span of every feature is cut into ``bins`` bins of equal width.  A level is one
    aggregate: rows and labels are summed by node, feature and bin in every task before the
    shuffle, so at most 2 ** level * inputs * bins sums meet, however many rows there are.  The
    driver sees one split a node.  Equal gains go to the first feature, then the lowest bin.
    Rows without a label are left out; features must be finite.  An empty table gives a tree without
    splits or means.
    """
    if depth < 0 or bins < 2:
        raise ValueError("depth must not be negative and two bins are the least")
    rows = train.where("label is not null").select("features", "label")
    x = vector_to_array("features")
    ends = [f(x[i]).alias(f"{name}{i}") for i in range(inputs) for name, f in (("low", F.min), ("high", F.max))]
    whole = rows.agg(*ends, F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean"), F.var_pop("label").alias("spread")).first()
    if not whole["n"]:
        return Tree((0.0,) * inputs, (0.0,) * inputs, bins, {}, {})
    low, high = (tuple(whole[f"{name}{i}"] for i in range(inputs)) for name in ("low", "high"))
    mean, scatter = whole["mean"], whole["n"] * whole["spread"]
    # labels around their mean, so that sums of large ones do not cancel out
    small = cut_lineage(rows.select(_binned("features", low, high, bins).alias("bins"), (F.col("label") - mean).alias("y")))

    splits: dict[int, Split] = {}
    for level in range(depth if scatter > 0 else 0):
        found = _best_splits(small.withColumn("node", _leaf(F.col("bins"), splits)).where(F.col("node") >= 1 << level), scatter).collect()
        for r in found:
            a, b = low[r["feature"]], high[r["feature"]]
            splits[r["node"]] = Split(r["node"], r["feature"], r["bin"], a + (r["bin"] + 1) * (b - a) / bins, r["gain"])
        if not found:
            break
    leaves = small.groupBy(_leaf(F.col("bins"), splits).alias("node")).agg(F.avg("y").alias("mean")).collect()
    return Tree(low, high, bins, splits, {r["node"]: r["mean"] + mean for r in leaves})


def _best_splits(rows: DataFrame, scatter: float) -> DataFrame:
    """node, feature, bin and gain of the best split of every node that has one; ``rows`` has node, bins and y."""
    sums = rows.select("node", "y", F.posexplode("bins").alias("feature", "bin")).groupBy("node", "feature", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")
    )
    whole = Window.partitionBy("node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sides = sums.select(
        "node", "feature", "bin", F.sum("n").over(upto).alias("nl"), F.sum("s").over(upto).alias("sl"),
        F.sum("n").over(whole).alias("nt"), F.sum("s").over(whole).alias("st"),
    ).where("nl < nt")
    right = F.col("st") - F.col("sl")
    gain = F.col("sl") * F.col("sl") / F.col("nl") + right * right / (F.col("nt") - F.col("nl")) - F.col("st") * F.col("st") / F.col("nt")
    scored = sides.select("node", "feature", "bin", F.round(gain / scatter, PLACES).alias("gain")).where("gain > 0")
    best = F.max(F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b")))
    return scored.groupBy("node").agg(best.alias("best")).select(
        "node", (-F.col("best.f")).alias("feature"), (-F.col("best.b")).alias("bin"), F.col("best.gain").alias("gain")
    )
