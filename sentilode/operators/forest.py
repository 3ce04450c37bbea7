"""Trees of a random forest as a table: one row per condition on the way from the root to a leaf.

A document reaches a leaf if it meets all its conditions. Most features of a document are zero, and whether a condition holds
for zero is a property of the table. So only the entries that a document has are joined with the conditions on
their features; what they change is summed per leaf, and trees without a change vote with the leaf of zeros.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sentilode.operators.scale import BROADCAST_BYTES, measured_bytes
from sentilode.session import materialize

NODES = (
    "tree int, node int, parent int, is_left boolean, feature int, threshold double, categories array<double>, "
    "left_if_in boolean, votes array<double>"
)


def tree_nodes(model: RandomForestClassificationModel) -> DataFrame:
    """(tree, node, parent, is_left, feature, threshold, categories, left_if_in, votes): all nodes of all trees.

    An inner node has a feature and a threshold, or the categories that go left (right, if `left_if_in` is false); a leaf has the share of each class
    in its votes. A model has at most 2 ** (depth + 1) nodes a tree, and is read where it is, in the driver.
    """
    rows = []
    for number, tree in enumerate(model._java_obj.trees()):
        weight = model.treeWeights[number]
        open_nodes = [(tree.rootNode(), None, False)]
        count = 0
        while open_nodes:
            node, parent, is_left = open_nodes.pop()
            own, count = count, count + 1
            feature = threshold = categories = left_if_in = votes = None
            if node.subtreeDepth() == 0:
                stats = list(node.impurityStats().stats())
                total = sum(stats)
                votes = [weight * s / total if total else 0.0 for s in stats]
            else:
                split = node.split()
                feature = split.featureIndex()
                if split.getClass().getSimpleName() == "ContinuousSplit":
                    threshold = split.threshold()
                else:
                    left, right = list(split.leftCategories()), list(split.rightCategories())
                    # The shorter side is listed; the other one has all other values.
                    left_if_in = len(left) <= len(right)
                    categories = left if left_if_in else right
                open_nodes += [(node.leftChild(), own, True), (node.rightChild(), own, False)]
            rows.append((number, own, parent, is_left, feature, threshold, categories, left_if_in, votes))
    return SparkSession.active().createDataFrame(rows, NODES)


def holds(value: Column) -> Column:
    """Does a condition (threshold or categories, left_if_in, is_left) hold for a value?"""
    goes_left = F.when(F.col("threshold").isNotNull(), value <= F.col("threshold")).otherwise(
        F.array_contains("categories", value) == F.col("left_if_in")
    )
    return goes_left == F.col("is_left")


def leaf_paths(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((tree, leaf, feature, threshold, categories, left_if_in, is_left, at_zero), (tree, leaf, votes, conditions, zeros)).

    The first table has a row per condition of a leaf, the second one per leaf: how many conditions it has, and how many hold for zero.
    The ways up are followed by a join per level.
    """
    nodes = materialize(nodes, "forest-nodes")
    leaves = nodes.filter(F.col("votes").isNotNull()).select("tree", F.col("node").alias("leaf"), "votes")
    above = nodes.select("tree", F.col("node").alias("up"), "feature", "threshold", "categories", "left_if_in", F.col("parent").alias("next"), F.col("is_left").alias("next_left"))
    way = nodes.filter(F.col("votes").isNotNull()).select(
        "tree", F.col("node").alias("leaf"), F.col("parent").alias("up"), "is_left"
    )
    found = None
    while True:
        way = materialize(way.filter(F.col("up").isNotNull()), "forest-level")
        if way.isEmpty():
            break
        step = way.join(above, ["tree", "up"])
        own = step.select("tree", "leaf", "feature", "threshold", "categories", "left_if_in", "is_left")
        found = own if found is None else found.unionByName(own)
        way = step.select("tree", "leaf", F.col("next").alias("up"), F.col("next_left").alias("is_left"))
    if found is None:  # every tree is a leaf
        found = nodes.select("tree", F.col("node").alias("leaf"), "feature", "threshold", "categories", "left_if_in", "is_left").limit(0)
    paths = materialize(found.withColumn("at_zero", holds(F.lit(0.0))), "forest-paths")
    counted = paths.groupBy("tree", "leaf").agg(F.count("*").alias("conditions"), F.count_if("at_zero").alias("zeros"))
    whole = leaves.join(counted, ["tree", "leaf"], "left").fillna(0, ["conditions", "zeros"])
    return paths, materialize(whole, "forest-leaves")


def votes(entries: DataFrame, keys: DataFrame, model: RandomForestClassificationModel, key: str = "doc_id") -> DataFrame:
    """(key, votes): the sum of all trees' class shares, by joins, for each row of `keys`.

    `entries` are the non-zero (key, index, value) of the features that the model splits; a key has an index once.
    Conditions are few beside documents and broadcast if their measured size allows; only sums per key, tree and leaf are shuffled.
    """
    paths, leaves = leaf_paths(tree_nodes(model))

    def near(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if measured_bytes(table) <= BROADCAST_BYTES else table

    zero = materialize(
        leaves.filter(F.col("conditions") == F.col("zeros")).select("tree", F.col("votes").alias("zero_votes")), "forest-zero"
    )
    changes = (
        entries.join(near(paths), entries["index"] == paths["feature"])
        .groupBy(key, "tree", "leaf")
        .agg(F.sum(F.coalesce(holds(F.col("value")), F.lit(False)).cast("int") - F.col("at_zero").cast("int")).alias("change"))
    )
    reached = (
        changes.join(near(leaves), ["tree", "leaf"])
        .filter(F.col("zeros") + F.col("change") == F.col("conditions"))
        .join(near(zero), "tree")
    )
    n = model.numClasses
    more = [F.sum(F.get("votes", F.lit(k)) - F.get("zero_votes", F.lit(k))).alias(f"_{k}") for k in range(n)]
    summed = reached.groupBy(key).agg(*more)
    # As many values as classes.
    base = zero.agg(*[F.sum(F.get("zero_votes", F.lit(k))) for k in range(n)]).first()
    total = F.array(*[F.coalesce(F.col(f"_{k}"), F.lit(0.0)) + F.lit(float(base[k] or 0.0)) for k in range(n)])
    return keys.select(key).join(summed, key, "left").select(key, total.alias("votes"))
