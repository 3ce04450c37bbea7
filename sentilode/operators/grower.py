"""The random forest learned from the entries that vectors store, the same trees as Spark's own fit grows.

That fit keeps a bin number for every feature of every row, a megabyte for a row of 262,144 features, and passes over them for
each level. Here a row keeps the bins of its entries alone. Counts of a node's features are summed over entries; what they leave of the
node's rows is the count of the bin of zero. Draws of rows and features, splits and ties are Spark's, so are the trees.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, functions as F

from sentilode.session import materialize, ship_package

# Utils.EPSILON of Spark: the distance of 1.0 to the next double.
EPSILON = float(np.finfo(np.float64).eps)
INVALID = -float(np.finfo(np.float64).max)
WORDS = 624
ROWS = "label int, odd boolean, weights array<int>, index array<int>, bin array<int>"
CELLS = "node int, cell int, n bigint"
BEST = "node int, feature int, at int, cut array<int>, gain double, all array<double>, left array<double>"


def poisson_draws(seed: int) -> Iterator[int]:
    """The draws of commons-math's Poisson distribution of mean 1, by its Well19937c generator with this seed."""
    v = [seed >> 32 & 0xFFFFFFFF, seed & 0xFFFFFFFF]
    for i in range(2, WORDS):
        x = v[i - 2] - ((v[i - 2] & 0x80000000) << 1)  # as a signed number
        v.append(1812433253 * (x ^ (x >> 30)) + i & 0xFFFFFFFF)
    at, least = 0, math.exp(-1.0)

    def bits() -> int:
        nonlocal at
        before, two = (at - 1) % WORDS, (at - 2) % WORDS
        a, b, c, d = v[at], v[(at + 70) % WORDS], v[(at + 179) % WORDS], v[(at + 449) % WORDS]
        z0 = (0x80000000 & v[before]) ^ (0x7FFFFFFF & v[two])
        z1 = (a ^ (a << 25 & 0xFFFFFFFF)) ^ (b ^ (b >> 27))
        z2 = (c >> 9) ^ (d ^ (d >> 1))
        z3 = z1 ^ z2
        z4 = z0 ^ (z1 ^ (z1 << 9 & 0xFFFFFFFF)) ^ (z2 ^ (z2 << 21 & 0xFFFFFFFF)) ^ (z3 ^ (z3 >> 21))
        v[at], v[before] = z3, z4
        v[two] &= 0x80000000
        at = before
        z4 ^= z4 << 7 & 0xE46E1700
        z4 ^= z4 << 15 & 0x9B868000
        return z4 >> 6

    while True:
        n, r = 0, 1.0
        while n < 1000:
            high = bits() << 26
            r *= (high | bits()) * 2.0**-52
            if r < least:
                break
            n += 1
        yield n


def thresholds(values: np.ndarray, counts: np.ndarray, expected: float, most: int) -> list[float]:
    """The splits of a feature from its distinct values but zero, in order, and their counts in a sample of `expected` rows; `most` of them."""
    seen = float(counts.sum())
    if expected - seen > EPSILON * int(counts.sum()) * 100:
        at = int(np.searchsorted(values, 0.0))
        values, counts = np.insert(values, at, 0.0), np.insert(counts.astype(np.float64), at, expected - seen)
    if len(values) - 1 <= most:
        return [float((a + b) / 2.0) for a, b in zip(values, values[1:])]
    stride = expected / (most + 1)
    found, current, target = [], float(counts[0]), stride
    for k in range(1, len(values)):
        previous, current = current, current + float(counts[k])
        if abs(previous - target) < abs(current - target):
            found.append(float((values[k - 1] + values[k]) / 2.0))
            target += stride
    return found


@dataclass
class Bins:
    """How values are cut: bins per feature, that of zero, thresholds of continuous features."""

    sizes: np.ndarray
    zero: np.ndarray
    categorical: np.ndarray
    cuts: dict[int, np.ndarray]

    def of(self, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The bin of each entry; a category is its own."""
        found = value.astype(np.int64)
        cut = np.flatnonzero(~self.categorical[index])
        cut = cut[np.argsort(index[cut], kind="stable")]
        features, starts = np.unique(index[cut], return_index=True)
        for feature, own in zip(features.tolist(), np.split(cut, starts[1:])):
            found[own] = np.searchsorted(self.cuts.get(feature, np.zeros(0)), value[own], side="left")
        return found


@dataclass
class Node:
    """A node of a tree while it grows: its split, if it has one, and its counts per class."""

    counts: list[float]
    gain: float = math.nan
    impurity: float = 0.0
    valid: bool = True
    feature: int = -1
    at: int = -1
    categories: list[int] = field(default_factory=list)
    left: np.ndarray | None = None  # per bin: does it go left?


def gini(counts) -> np.ndarray:
    """The impurity of counts per class, in the last dimension; 0 without any."""
    counts = np.asarray(counts, np.float64)
    total = counts.sum(axis=-1)
    found = np.ones(total.shape)
    for k in range(counts.shape[-1]):
        share = np.divide(counts[..., k], total, out=np.zeros(total.shape), where=total > 0)
        found = found - share * share
    return np.where(total > 0, found, 0.0)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, the begin of each row's and the end) of a column of arrays."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    starts = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), starts - starts[0]


def _drawn(bins: Bins, trees: int, seed: int) -> Callable:
    """A function of a partition's (label, odd, index, value): each row with its weight in each tree and the bins of entries that differ from zero's."""

    def run(batches):
        draws = poisson_draws(seed + TaskContext.get().partitionId() + 1)
        for batch in batches:
            n = batch.num_rows
            index, starts = _flat(batch["index"])
            value, _ = _flat(batch["value"])
            cut = bins.of(index, value)
            kept = cut != bins.zero[index]
            ends = np.concatenate([[0], np.cumsum(kept)])[starts].astype(np.int32)
            weights = np.fromiter((next(draws) for _ in range(n * trees)), np.int32, n * trees)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["label"], batch["odd"], pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * trees, weights),
                    pa.ListArray.from_arrays(ends, index[kept].astype(np.int32)), pa.ListArray.from_arrays(ends, cut[kept].astype(np.int32)),
                ],
                ["label", "odd", "weights", "index", "bin"],
            )

    return run


@dataclass
class Group:
    """Nodes whose splits one pass finds: (tree, node) by number, the features of each, and where the cells of each feature begin."""

    nodes: list[tuple[int, int]]
    features: list[np.ndarray]
    starts: list[np.ndarray]
    cells: int


def _counted(bins: Bins, grown: list[dict[int, Node]], group: Group, classes: int) -> Callable:
    """A function of a partition of rows: (node, cell, n), the weights per class of the entries in each bin of a node's features; cells below 0 are all rows."""
    numbers = [{node: k for k, (t, node) in enumerate(group.nodes) if t == tree} for tree in range(len(grown))]

    def run(batches):
        cells = np.zeros(group.cells * classes, np.int64)
        totals = np.zeros((len(group.nodes), classes), np.int64)
        for batch in batches:
            label = batch["label"].to_numpy(zero_copy_only=False).astype(np.int64)
            weights = _flat(batch["weights"])[0].reshape(len(label), -1)
            index, starts = _flat(batch["index"])
            order = np.argsort(index, kind="stable")
            row = np.repeat(np.arange(len(label)), np.diff(starts))[order]
            cut, index = _flat(batch["bin"])[0][order], index[order]
            for tree, nodes in enumerate(grown):
                if not numbers[tree]:
                    continue
                place = np.ones(len(label), np.int64)
                for node in sorted(n for n in nodes if nodes[n].left is not None):
                    split = nodes[node]
                    goes = np.full(len(label), split.left[bins.zero[split.feature]])
                    lo, hi = np.searchsorted(index, [split.feature, split.feature + 1])
                    goes[row[lo:hi]] = split.left[cut[lo:hi]]
                    place = np.where(place == node, 2 * node + np.where(goes, 0, 1), place)
                number = np.full(max(int(place.max(initial=1)), max(numbers[tree])) + 1, -1)
                number[list(numbers[tree])] = list(numbers[tree].values())
                own, weight = number[place], weights[:, tree].astype(np.int64)
                there = (own >= 0) & (weight > 0)
                np.add.at(totals, (own[there], label[there]), weight[there])
                own = np.where(there, own, -1)
                wanted = np.concatenate([group.features[k] for k in numbers[tree].values()])
                begins = np.concatenate([group.starts[k] for k in numbers[tree].values()])
                of = np.concatenate([np.full(len(group.features[k]), k) for k in numbers[tree].values()])
                lo, hi = np.searchsorted(index, wanted), np.searchsorted(index, wanted, side="right")
                sizes = hi - lo
                entry = np.arange(sizes.sum()) + np.repeat(lo - np.cumsum(sizes) + sizes, sizes)
                kept = own[row[entry]] == np.repeat(of, sizes)
                entry, begin = entry[kept], np.repeat(begins, sizes)[kept]
                np.add.at(cells, (begin + cut[entry]) * classes + label[row[entry]], weight[row[entry]])
        some = np.flatnonzero(cells)
        firsts = np.array([s[0] for s in group.starts]) * classes
        node = np.searchsorted(firsts, some, side="right") - 1
        whole = np.repeat(np.arange(len(group.nodes)), classes)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([whole, node]).astype(np.int32)),
                pa.array(np.concatenate([np.tile(-1 - np.arange(classes), len(group.nodes)), some - firsts[node]]).astype(np.int32)),
                pa.array(np.concatenate([totals.ravel(), cells[some]])),
            ],
            ["node", "cell", "n"],
        )

    return run


def best_split(
    counts: np.ndarray, total: np.ndarray, features: np.ndarray, starts: np.ndarray, bins: Bins, least: int, least_gain: float
) -> tuple[int, int, list[int] | None, float, np.ndarray] | None:
    """(feature, split, its categories, gain, counts of the left side) of a node; of equal ones the first. None without any split.

    `counts` are per bin of each feature and class, without the bin of zero, which is what is left of `total`.
    """
    found = None
    impurity = float(gini(total))
    for feature, start in zip(features, starts):
        size = int(bins.sizes[feature])
        if size < 2:
            continue
        own = counts[start : start + size].astype(np.float64)
        own[bins.zero[feature]] = total - own.sum(axis=0)
        order = None
        if bins.categorical[feature]:
            centroid = np.where(own.sum(axis=1) > 0, own[:, 1], np.finfo(np.float64).max)
            order = np.argsort(centroid, kind="stable")
            own = own[order]
        left = np.cumsum(own, axis=0)[:-1]
        right = total - left
        n_left, n_right = left.sum(axis=1), right.sum(axis=1)
        n = n_left + n_right
        share = lambda part: np.divide(part, n, out=np.zeros(len(n)), where=n > 0)
        gain = impurity - share(n_left) * gini(left) - share(n_right) * gini(right)
        gain = np.where((n_left < least) | (n_right < least) | (gain < least_gain), INVALID, gain)
        at = int(gain.argmax())
        if found is None or gain[at] > found[3]:
            found = int(feature), at, None if order is None else order[: at + 1].tolist(), float(gain[at]), left[at]
    return found


def _best(bins: Bins, group: Group, classes: int, least: int, least_gain: float) -> Callable:
    """A function of the cells of one node: its best split."""

    def run(table: pa.Table) -> pa.Table:
        k = table["node"][0].as_py()
        cell, n = table["cell"].to_numpy(), table["n"].to_numpy()
        total = np.zeros(classes)
        total[-1 - cell[cell < 0]] = n[cell < 0]
        features, starts = group.features[k], group.starts[k] - group.starts[k][0]
        counts = np.zeros(int(bins.sizes[features].sum()) * classes)
        counts[cell[cell >= 0]] = n[cell >= 0]
        found = best_split(counts.reshape(-1, classes), total, features, starts, bins, least, least_gain)
        feature, at, cut, gain, left = found or (-1, -1, None, INVALID, np.zeros(classes))
        types = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        line = [k, feature, at, cut, gain, total.tolist(), left.tolist()]
        names = ["node", "feature", "at", "cut", "gain", "all", "left"]
        return pa.table({name: pa.array([x], t) for name, x, t in zip(names, line, types)})

    return run


class EntryForest(RandomForestClassifier):
    """The random forest, learned from the entries that vectors store. Its model is Spark's, with the trees of Spark's own fit.

    Settings that the jobs do not use (more or fewer classes than two, weights, other impurities, samples or subsets of features) are left to that
    fit, and so are inputs that it refuses. What grows with the rows is a table of their entries; a task holds the counts of a group of nodes, which
    `maxMemoryInMB` bounds as in Spark.
    """

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        spark, jvm = dataset.sparkSession, dataset.sparkSession._jvm
        trees, classes = self.getNumTrees(), 2
        usual = (
            trees > 1 and self.getImpurity() == "gini" and self.getFeatureSubsetStrategy() in ("auto", "sqrt") and self.getBootstrap()
            and self.getSubsamplingRate() == 1.0 and self.getMinWeightFractionPerNode() == 0.0 and not self.isDefined(self.weightCol)
            and not dataset.schema[self.getLabelCol()].metadata and self.getMaxDepth() > 0
        )
        if not usual:
            return super()._fit(dataset)
        label = F.col(self.getLabelCol()).cast("double")
        seen = dataset.agg(
            F.count("*").alias("n"), F.max(label).alias("last"), F.max(~F.coalesce(label.isin(0.0, 1.0), F.lit(False))).alias("odd")
        ).first()
        if seen["odd"] or seen["last"] != 1.0:
            return super()._fit(dataset)
        v = F.unwrap_udt(self.getFeaturesCol())
        wide = F.coalesce(v["size"], F.size(v["values"]))
        n, size = seen["n"], dataset.select(wide).first()[0]
        if not size or size < 2:
            return super()._fit(dataset)
        odd = F.coalesce(wide != size, F.lit(True)) | F.exists(v["values"], lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
        index = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
        rows = dataset.select(label.cast("int").alias("label"), odd.alias("odd"), index.alias("index"), v["values"].alias("value"))
        for name, kind in (("index", "int"), ("value", "double")):
            rows = rows.withColumn(name, F.when(~F.col("odd"), F.col(name)).otherwise(F.array().cast(f"array<{kind}>")))
        listed = jvm.org.apache.spark.ml.util.MetadataUtils.getCategoricalFeatures(
            dataset._jdf.schema().apply(self.getFeaturesCol())
        ).mkString(",")
        arity = np.zeros(size, np.int64)
        for pair in filter(None, listed.split(",")):
            feature, count = pair.split(" -> ")
            arity[int(feature)] = int(count)
        most = min(self.getMaxBins(), n)
        if ((arity == 1) | (arity > most)).any():
            return super()._fit(dataset)
        ship_package(spark)
        bins = self._bins(rows, arity, most, n)
        drawn = materialize(rows.mapInArrow(_drawn(bins, trees, self.getSeed()), ROWS), "forest-rows")
        if not drawn.filter("odd").isEmpty():
            return super()._fit(dataset)
        return self._model(spark, self._grown(spark, drawn, bins, trees, classes), bins, size, classes)

    def _bins(self, rows: DataFrame, arity: np.ndarray, most: int, n: int) -> Bins:
        """The cuts of continuous features, from Spark's sample of rows: 10,000 of them or the square of the most bins."""
        spark, jvm = rows.sparkSession, rows.sparkSession._jvm
        needed = max(self.getMaxBins() ** 2, 10_000)
        part = needed / n if needed < n else 1.0
        cuts: dict[int, np.ndarray] = {}
        if (arity == 0).any():
            sample = rows.select("index", "value")
            if part < 1:
                seed = jvm.org.apache.spark.util.random.XORShiftRandom(self.getSeed()).nextInt()
                drawn = sample._jdf.javaRDD().sample(False, part, seed)
                sample = DataFrame(spark._jsparkSession.createDataFrame(drawn, sample._jdf.schema()), spark)
            every = F.split(F.lit(",".join(map(str, np.flatnonzero(arity == 0).tolist()))), ",").cast("array<int>")
            of = spark.range(1).select(F.explode(every).alias("index"))
            entries = sample.select(F.inline(F.arrays_zip("index", "value"))).filter("value <> 0")
            counted = entries.join(F.broadcast(of), "index", "left_semi").groupBy("index", "value").agg(F.count("*").alias("n"))
            most_cuts, expected = most - 1, part * n

            def cut(table: pa.Table) -> pa.Table:
                order = np.argsort(table["value"].to_numpy(), kind="stable")
                found = thresholds(table["value"].to_numpy()[order], table["n"].to_numpy()[order], expected, most_cuts)
                return pa.table({"index": table["index"][:1].cast(pa.int32()), "cuts": pa.array([found], pa.list_(pa.float64()))})

            for r in counted.groupBy("index").applyInArrow(cut, "index int, cuts array<double>").collect():
                cuts[r["index"]] = np.array(r["cuts"])
        sizes = np.where(arity > 0, arity, 1)
        zero = np.zeros(len(arity), np.int64)
        for feature, own in cuts.items():
            sizes[feature] = len(own) + 1
            zero[feature] = np.searchsorted(own, 0.0, side="left")
        return Bins(sizes, zero, arity > 0, {k: c for k, c in cuts.items() if len(c)})

    def _grown(self, spark, drawn: DataFrame, bins: Bins, trees: int, classes: int) -> list[dict[int, Node]]:
        """The nodes of each tree by number: the root is 1, the children of k are 2 k and 2 k + 1."""
        jvm, size, depth = spark._jvm, len(bins.sizes), self.getMaxDepth()
        each = math.ceil(math.sqrt(size))
        random = jvm.java.util.Random(self.getSeed())
        tag = jvm.scala.reflect.ClassTag.Int()
        room = self.getMaxMemoryInMB() * 1024 * 1024
        grown: list[dict[int, Node]] = [{} for _ in range(trees)]
        stack = [(tree, 1) for tree in range(trees)][::-1]  # the first one is next
        while stack:
            group, used = Group([], [], [], 0), 0
            by_tree = jvm.java.util.HashMap()
            while stack:
                features = np.arange(size)
                if each < size:
                    every = jvm.scala.collection.immutable.Range.Exclusive(0, size, 1).iterator()
                    subset = jvm.org.apache.spark.util.random.SamplingUtils.reservoirSampleAndCount(every, each, random.nextLong(), tag)._1()
                    features = np.array(jvm.java.util.Arrays.toString(subset)[1:-1].split(","), np.int64)
                needs = int(bins.sizes[features].sum())
                if used and used + needs * classes * 8 > room:
                    break  # the node's features are drawn again for the next group
                tree, node = stack.pop(0)
                group.nodes.append((tree, node))
                group.features.append(features)
                group.starts.append(group.cells + np.cumsum(bins.sizes[features]) - bins.sizes[features])
                group.cells += needs
                by_tree.put(tree, tree)
                used += needs * classes * 8
            counted = drawn.mapInArrow(_counted(bins, grown, group, classes), CELLS).groupBy("node", "cell").agg(F.sum("n").alias("n"))
            best = _best(bins, group, classes, self.getMinInstancesPerNode(), self.getMinInfoGain())
            found = {r["node"]: r for r in counted.groupBy("node").applyInArrow(best, BEST).collect()}  # a row per node
            # Spark goes through the trees in the order of its map.
            in_order = jvm.org.apache.spark.api.python.PythonUtils.toScalaMap(by_tree).keysIterator().mkString(",")
            for tree in map(int, in_order.split(",")):
                for k, (_, number) in [x for x in enumerate(group.nodes) if x[1][0] == tree]:
                    r = found[k]
                    node = grown[tree][number] = Node(r["all"], r["gain"], float(gini(r["all"])), r["gain"] != INVALID)
                    if r["gain"] <= 0:
                        continue
                    node.feature, node.at = r["feature"], r["at"]
                    node.left = np.arange(bins.sizes[node.feature]) <= node.at
                    if r["cut"] is not None:
                        node.categories = r["cut"]
                        node.left = np.isin(np.arange(bins.sizes[node.feature]), r["cut"])
                    last = number.bit_length() == depth
                    for child, counts in ((2 * number, r["left"]), (2 * number + 1, [a - b for a, b in zip(r["all"], r["left"])])):
                        impurity = float(gini(counts))
                        grown[tree][child] = Node(counts, impurity=impurity)
                        if not last and not abs(impurity) < EPSILON:
                            stack.insert(0, (tree, child))
        return grown

    def _model(self, spark, grown: list[dict[int, Node]], bins: Bins, size: int, classes: int) -> RandomForestClassificationModel:
        jvm, new_array = spark._jvm, spark.sparkContext._gateway.new_array
        ml = jvm.org.apache.spark.ml

        def doubles(values):
            array = new_array(jvm.double, len(values))
            for k, value in enumerate(values):
                array[k] = float(value)
            return array

        def built(nodes: dict[int, Node], number: int):
            """(the node, its prediction if it is a leaf)"""
            node = nodes[number]
            stats = jvm.org.apache.spark.mllib.tree.impurity.GiniCalculator(doubles(node.counts), int(sum(node.counts)))
            predicted = float(np.argmax(node.counts))
            if node.left is None:
                return ml.tree.LeafNode(predicted, node.impurity if node.valid else -1.0, stats), predicted
            (left, a), (right, b) = built(nodes, 2 * number), built(nodes, 2 * number + 1)
            if a is not None and a == b:
                return ml.tree.LeafNode(a, node.impurity, stats), a
            if bins.categorical[node.feature]:
                split = ml.tree.CategoricalSplit(node.feature, doubles(node.categories), int(bins.sizes[node.feature]))
            else:
                split = ml.tree.ContinuousSplit(node.feature, float(bins.cuts[node.feature][node.at]))
            return ml.tree.InternalNode(predicted, node.impurity, node.gain, left, right, split, stats), None

        kind = ml.classification.DecisionTreeClassificationModel
        array = new_array(kind, len(grown))
        for k, nodes in enumerate(grown):
            array[k] = kind(built(nodes, 1)[0], size, classes)
        self._transfer_params_to_java()
        java = ml.classification.RandomForestClassificationModel(self.uid, array, size, classes)
        self._java_obj.copyValues(java, ml.param.ParamMap.empty())
        java.setParent(self._java_obj)
        return self._copyValues(self._create_model(java))
