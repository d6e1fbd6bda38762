"""Regularised gradient boosting over DataFrame aggregates, several models on one scan.

Features are binned once. A level of a tree is one aggregate: sums of gradients and weights by model,
node, feature and bin, from which the split of largest second-order gain of every node follows. Models
that differ in their row weights only (other decay rates, or cutoffs as weight 0) are slots of the same
aggregate, so any number of them grows on one scan a level. What reaches the driver is one row per node.

A model is a table of nodes. Scoring walks it in one expression: the table is attached as one array,
whose size is fixed by the number of trees and their depth, and no row is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandcast.operators.joins import attach_one_row
from demandcast.sources.storage import Storage

NODES = "slot int, tree int, node int, feature int, threshold double, value double"
BASES = "slot int, base double"


@dataclass(frozen=True)
class BoostParams:
    """Settings of the learner; squared error."""

    # fixed values: learner settings that results must share
    n_trees: int = 400
    max_depth: int = 6
    step_size: float = 0.05
    row_fraction: float = 0.8
    column_fraction: float = 0.8
    min_child_weight: float = 5.0
    gamma: float = 1.0
    l2: float = 5.0
    seed: int = 42
    # of this learner
    max_bins: int = 64
    store_every: int = 8


@dataclass(frozen=True)
class Boosted:
    """Fitted models: ``nodes`` (NODES; a leaf has no feature) and ``bases`` (BASES) as rows, for these features in this order."""

    features: tuple[str, ...]
    depth: int
    nodes: list[tuple]
    bases: list[tuple]

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame(self.bases, BASES).coalesce(1).write.mode("overwrite").parquet(f"{path}/bases")
        names = [(n, name, self.depth) for n, name in enumerate(self.features)]
        spark.createDataFrame(names, "place int, feature string, depth int").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        names = spark.read.parquet(f"{path}/features").orderBy("place").collect()
        nodes = [tuple(r) for r in spark.read.parquet(f"{path}/nodes").orderBy("slot", "tree", "node").collect()]
        bases = [tuple(r) for r in spark.read.parquet(f"{path}/bases").orderBy("slot").collect()]
        return Boosted(tuple(r["feature"] for r in names), names[0]["depth"], nodes, bases)


def bin_edges(rows: DataFrame, features: Sequence[str], max_bins: int) -> list[list[float]]:
    """At most ``max_bins`` - 1 approximate quantiles of each feature, one pass for all."""
    steps = [i / max_bins for i in range(1, max_bins)]
    found = rows.agg(*[F.percentile_approx(F.col(f).cast("double"), steps, 10_000).alias(f"e{n}") for n, f in enumerate(features)]).first()
    return [sorted(set(e or [])) for e in found]


def _bins(features: Sequence[str], edges: list[list[float]]) -> Column:
    """How many edges are below each feature's value."""
    values = F.array(*[F.col(f).cast("double") for f in features])
    limits = F.array(*[F.array(*[F.lit(float(e)) for e in own]).cast("array<double>") for own in edges])
    return F.zip_with(values, limits, lambda value, own: F.size(F.filter(own, lambda e: e < value)))


def _share(key: Column, fraction: float, *salt: int) -> Column:
    """Whether a hash of the key falls into the first ``fraction`` of its range."""
    return F.pmod(F.xxhash64(key, *[F.lit(s) for s in salt]), F.lit(1 << 20)) < int(fraction * (1 << 20))


def _walk(nodes: dict[int, tuple[int, int]], depth: int) -> Column:
    """Node that a row reaches in a tree under construction; ``nodes`` has (feature, bin) of those that are split."""
    if not nodes:
        return F.lit(0)
    size = max(nodes) + 1
    feature = F.array(*[F.lit(nodes.get(n, (-1, 0))[0]) for n in range(size)])
    limit = F.array(*[F.lit(nodes.get(n, (-1, 0))[1]) for n in range(size)])

    def step(node: Column, _: Column) -> Column:
        own = F.coalesce(F.get(feature, node), F.lit(-1))
        right = (F.get(F.col("bins"), own) > F.get(limit, node)).cast("int")
        return F.when(own < 0, node).otherwise(2 * node + 1 + right)

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)


def _best_splits(state: DataFrame, walks: list[Column], fresh: list[list[int]], tree: int, slots: int, params: BoostParams, n_features: int) -> dict:
    """(slot, node) -> (gradient, weight, feature or None, bin) of this level's nodes."""
    taken = _share(F.col("row"), params.row_fraction, params.seed, tree)
    parts = []
    for slot in range(slots):
        weight = F.col("weights")[slot]
        parts.append(F.struct(F.lit(slot).alias("slot"), walks[slot].alias("node"), (weight * (F.col("predicted")[slot] - F.col("label"))).alias("g"), weight.alias("h")))
    level = state.where(taken).select("bins", F.explode(F.array(*parts)).alias("s")).select("bins", "s.*").where("h > 0")
    wanted = F.array(*[F.lit(slot * (1 << 20) + node) for slot in range(slots) for node in fresh[slot]])
    level = level.where(F.array_contains(wanted, F.col("slot") * (1 << 20) + F.col("node")))
    cells = level.select("slot", "node", "g", "h", F.posexplode("bins").alias("feature", "bin"))
    sums = cells.groupBy("slot", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    each = Window.partitionBy("slot", "node", "feature")
    upto = each.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sides = sums.select(
        "slot", "node", "feature", "bin", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
        F.sum("g").over(each).alias("gt"), F.sum("h").over(each).alias("ht"),
    )

    def score(g: Column, h: Column) -> Column:
        return g * g / (h + params.l2)

    gr, hr = F.col("gt") - F.col("gl"), F.col("ht") - F.col("hl")
    gain = 0.5 * (score(F.col("gl"), F.col("hl")) + score(gr, hr) - score(F.col("gt"), F.col("ht"))) - params.gamma
    may = (F.col("hl") >= params.min_child_weight) & (hr >= params.min_child_weight)
    if params.column_fraction < 1:
        may &= _share(F.col("feature"), params.column_fraction, params.seed, tree, 7)
    # ten significant digits, so that equal gains do not hang on the order of summation; ties go to the first feature and bin
    gain = F.when(may & (gain > 0), F.format_string("%.9e", gain).cast("double"))
    sides = sides.withColumn("gain", gain)
    choice = F.struct(F.coalesce("gain", F.lit(-1.0)).alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"))
    found = sides.groupBy("slot", "node").agg(F.max(choice).alias("best"), F.min_by("gt", "feature").alias("g"), F.min_by("ht", "feature").alias("h"))
    return {
        (r["slot"], r["node"]): (r["g"], r["h"], None if r["best"]["gain"] < 0 else -r["best"]["f"], -r["best"]["b"])
        for r in found.collect()  # one row per node
    }


def fit_boosted(
    rows: DataFrame, features: Sequence[str], label: Column, weights: Sequence[Column], storage: Storage, params: BoostParams = BoostParams()
) -> Boosted:
    """One model per weight column, all grown together.

    Rows with weight 0 or null do not count for a model, rows without a label for none. A null feature counts as below every
    threshold. Rows of equal features and label are sampled together. Without any row the models have no trees and base 0.
    """
    if params.max_depth > 16:
        raise ValueError("max_depth must be at most 16")
    slots = len(weights)
    base = rows.select(*features, label.cast("double").alias("_label"), *[F.coalesce(w.cast("double"), F.lit(0.0)).alias(f"_w{i}") for i, w in enumerate(weights)])
    base = base.where(F.col("_label").isNotNull())
    edges = bin_edges(base, features, params.max_bins)
    means = base.agg(*[F.try_divide(F.sum(F.col(f"_w{i}") * F.col("_label")), F.sum(f"_w{i}")) for i in range(slots)]).first()
    start = [m if m is not None and math.isfinite(m) else 0.0 for m in means]
    state = base.select(
        F.xxhash64(*features, "_label").alias("row"), _bins(features, edges).alias("bins"), F.col("_label").alias("label"),
        F.array(*[F.col(f"_w{i}") for i in range(slots)]).alias("weights"), F.array(*[F.lit(b) for b in start]).alias("predicted"),
    )
    state = storage.table("boost0", state)
    nodes: list[tuple] = []
    for tree in range(params.n_trees):
        split: list[dict[int, tuple[int, int]]] = [{} for _ in range(slots)]
        value: list[dict[int, float]] = [{} for _ in range(slots)]
        fresh: list[list[int]] = [[0] for _ in range(slots)]
        for depth in range(params.max_depth + 1):
            if not any(fresh):
                break
            walks = [_walk(split[s], depth) if depth else F.lit(0) for s in range(slots)]
            found = _best_splits(state, walks, fresh, tree, slots, params, len(features))
            fresh = [[] for _ in range(slots)]
            for (s, node), (g, h, feature, limit) in sorted(found.items()):
                value[s][node] = -params.step_size * g / (h + params.l2)
                if feature is not None and depth < params.max_depth:
                    split[s][node] = (feature, limit)
                    fresh[s] += [2 * node + 1, 2 * node + 2]
        for s in range(slots):
            for node in sorted(value[s]):
                feature, limit = split[s].get(node, (None, None))
                threshold = edges[feature][limit] if feature is not None else None
                nodes.append((s, tree, node, feature, threshold, None if feature is not None else value[s][node]))
        grown = []
        for s in range(slots):
            size = max(value[s], default=-1) + 1
            leaf = F.array(*[F.lit(float(value[s].get(n, 0.0))) for n in range(size)]) if size else F.array(F.lit(0.0))
            grown.append(F.col("predicted")[s] + F.coalesce(F.get(leaf, _walk(split[s], params.max_depth)), F.lit(0.0)))
        state = state.withColumn("predicted", F.array(*grown))
        if (tree + 1) % params.store_every == 0 and tree + 1 < params.n_trees:
            state = storage.table(f"boost{tree + 1}", state)
    return Boosted(tuple(features), params.max_depth, sorted(nodes, key=lambda n: n[:3]), list(enumerate(start)))


def predict_boosted(model: Boosted, rows: DataFrame, slot: int = 0, name: str = "prediction") -> DataFrame:
    """Add the model's prediction. The nodes are attached as one array per row of the broadcast, of a size fixed by the fit."""
    own = [n for n in model.nodes if n[0] == slot]
    trees: list[list[tuple]] = []
    for _, tree, node, feature, threshold, value in own:
        while len(trees) <= tree:
            trees.append([])
        while len(trees[tree]) <= node:
            trees[tree].append((None, None, 0.0))
        trees[tree][node] = (feature, threshold, value)
    spark = rows.sparkSession
    one = spark.createDataFrame([(trees,)], "_trees array<array<struct<feature:int,threshold:double,value:double>>>")
    values = F.array(*[F.col(f).cast("double") for f in model.features])

    def leaf(tree: Column, held: Column) -> Column:
        def step(node: Column, _: Column) -> Column:
            at = F.get(tree, node)
            right = F.coalesce((F.get(held, at["feature"]) > at["threshold"]).cast("int"), F.lit(0))
            return F.when(at["feature"].isNull(), node).otherwise(2 * node + 1 + right)

        last = F.aggregate(F.sequence(F.lit(1), F.lit(model.depth)), F.lit(0), step)
        return F.coalesce(F.get(tree, last)["value"], F.lit(0.0))

    both = attach_one_row(rows.withColumn("_values", values), one)
    total = F.aggregate("_trees", F.lit(float(model.bases[slot][1])), lambda acc, tree: acc + leaf(tree, F.col("_values")))
    return both.withColumn(name, total).drop("_trees", "_values")
