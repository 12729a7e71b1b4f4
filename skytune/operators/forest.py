"""Regression forests that grow level by level over rows that stay in files.

The trees are those of Spark's ``RandomForestRegressor`` (all features in every node, bootstrap,
variance): the same thresholds to choose from, its own draws, sums added in the same order. Spark
keeps a row with its 200 draws as a kilobyte of objects, which large inputs read back from disk in
each of a hundred passes. Here a row takes a byte per feature and per draw, and a level is one pass:
a task sums a few trees over all rows in arrays that stay near the processor and picks their splits.
Of two sides of a split only the one with fewer rows is summed, the other is what it leaves of the
whole, so sums may differ from Spark's in their last digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import iadd

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytune.session import delete, release, setting, shared_folder, ship_package, written

BINS = 32
#: As many rows fit in memory as Spark keeps them, and its own fit has less to start.
FEW_ROWS = 100_000
#: A task keeps sums of a level's nodes, which double with the depth.
DEEPEST = 8
#: Rows whose values make one row of a file.
BLOCK = 256
#: Rows that a task sums at once.
CHUNK = 16384
#: Tasks per core in the pass of a level.
TASKS_PER_CORE = 2
INVALID = -np.finfo(float).max
EPSILON = np.finfo(float).eps
#: A row's node that ended above the level.
NOWHERE = -1


def thresholds(sample: np.ndarray, rows: int, share: float) -> list[np.ndarray]:
    """Per column of a sample the thresholds that Spark's trees choose from.

    ``sample`` holds about ``share`` of ``rows``. Zeros are not counted but taken as what the rest
    leaves, as Spark does.
    """
    expected, most = share * rows, min(BINS, rows) - 1
    found = []
    for column in sample.T:
        values, counts = np.unique(column[column != 0.0], return_counts=True)
        seen, counts = int(counts.sum()), counts.astype(float)
        if not seen:
            found.append(np.empty(0))
            continue
        if expected - seen > EPSILON * seen * 100:
            at = np.searchsorted(values, 0.0)
            values = np.insert(values, at, 0.0)
            counts = np.insert(counts, at, expected - seen)
        between = (values[:-1] + values[1:]) / 2.0
        if len(between) > most:
            stride, chosen, passed = expected / (most + 1), [], counts[0]
            target = stride
            for i in range(1, len(values)):
                before, passed = passed, passed + counts[i]
                if abs(before - target) < abs(passed - target):
                    chosen.append(between[i - 1])
                    target += stride
            between = np.array(chosen)
        found.append(between)
    return found


# --- rows to files -------------------------------------------------------------------


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value per first index of an array."""
    data = np.ascontiguousarray(rows)
    width = data.nbytes // max(len(data), 1)
    offsets = np.arange(len(data) + 1, dtype=np.int32) * np.int32(width)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    )


def _blocks(rows: np.ndarray) -> pa.Array:
    """Binary values of ``BLOCK`` rows each, the last one of the rest."""
    data = np.ascontiguousarray(rows)
    width = data.nbytes // max(len(data), 1)
    ends = np.minimum(np.arange(-(-len(data) // BLOCK) + 1) * BLOCK, len(data)) * width
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)]
    )


def _bytes(values: pa.Array) -> np.ndarray:
    """The bytes of adjacent binary values."""
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int32)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.empty(0, np.uint8)


def _record(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row as the bytes of its numbers."""
    for batch in batches:
        if any(column.null_count for column in batch.columns):
            raise ValueError("a row to train on lacks a value")
        values = np.column_stack([column.to_numpy() for column in batch.columns])
        if not np.isfinite(values[:, :-1]).all() or np.isnan(values[:, -1]).any():
            raise ValueError("a row to train on has a value that is no number")
        yield pa.RecordBatch.from_arrays([_binary(values)], ["record"])


def _drawn(spark: SparkSession, records: object, trees: int, seed: int) -> DataFrame:
    """Records with the number of draws in each tree, as Spark serialises its bagged rows.

    The draws follow the place of a row in its partition, so they are made by the class that makes
    them for Spark's forest.
    """
    jvm = spark._jvm
    name = "org.apache.spark.ml.tree.impl.BaggedPoint"
    bagged = jvm.org.apache.spark.ml.tree.impl.BaggedPoint
    unweighted = getattr(bagged, "convertToBaggedRDD$default$5")()
    rows = bagged.convertToBaggedRDD(records, 1.0, trees, True, unweighted, seed)
    encoder = jvm.org.apache.spark.sql.Encoders.javaSerialization(jvm.java.lang.Class.forName(name))
    return DataFrame(spark._jsparkSession.createDataset(rows, encoder).toDF(), spark)


#: How Java begins an array of bytes, and the bytes of an array before its elements. The last four
#: of these are its length.
_BYTES, _HEAD = b"ur\x00\x02[B", 23


def _parted(serialised: np.ndarray, width: int, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and draws of serialised rows, which are alike but for these."""
    start = serialised[0].tobytes().find(_BYTES) + _HEAD
    end = start + 8 * width
    draws = end + _HEAD
    lengths = serialised[:, [*range(start - 4, start), *range(draws - 4, draws)]]
    known = np.array([8 * width, trees], ">i4").view(np.uint8)
    if start < _HEAD or not (lengths == known).all():
        raise ValueError("bagged rows are serialised in an unknown way")
    values = np.ascontiguousarray(serialised[:, start:end]).view(np.float64)
    return values, serialised[:, draws + 3 : draws + 4 * trees : 4]


def _packed(
    edges: Sequence[np.ndarray], groups: Sequence[range]
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    trees, width = groups[-1].stop, len(edges) + 1

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            serialised = _bytes(batch.column(0)).reshape(batch.num_rows, -1)
            values, draws = _parted(serialised, width, trees)
            bins = np.column_stack(
                [np.searchsorted(e, values[:, f]).astype(np.uint8) for f, e in enumerate(edges)]
            )
            columns = [_blocks(bins), _blocks(values[:, -1]), *(_blocks(draws[:, g.start : g.stop]) for g in groups)]
            parts = pa.array(np.full(len(columns[0]), part, np.int32))
            names = ["part", "bins", "label", *(f"draws{k}" for k in range(len(groups)))]
            yield pa.RecordBatch.from_arrays([parts, *columns], names)

    return pack


# --- one level -----------------------------------------------------------------------


@dataclass
class Forest:
    """What is known of the trees, nodes numbered from the root through the levels.

    ``feature`` is -1 where a node has no split (yet). Nodes that grow now have a place in their
    tree: first those that rows are added to, which ``slot`` has (-1 for others), ``summed`` of them;
    then those of ``rest``, with the place of their sibling and that of their parent a level before.
    ``parent`` and ``impurity`` are by place, what the parent's split told of a node.
    """

    feature: np.ndarray
    split: np.ndarray
    slot: np.ndarray
    summed: list[int]
    rest: list[np.ndarray]
    impurity: list[np.ndarray]
    parent: list[np.ndarray]
    level: int
    last: bool


def _nodes(forest: Forest, tree: int, bins: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of ``hit`` that are in a node to sum, and its slot."""
    flat, start = bins.ravel(), hit * bins.shape[1]
    feature, split = forest.feature[tree], forest.split[tree]
    node = np.zeros(len(hit), np.int64)
    for level in range(forest.level):
        first = 2**level - 1
        f = feature.take(node)
        if (feature[first : 2 * first + 1] < 0).any() and not (on := f >= 0).all():
            hit, start, node, f = hit[on], start[on], node[on], f[on]
        start_f = start + f
        right = flat.take(start_f) > split.take(node)
        node *= 2
        node += 1
        node += right
    slot = forest.slot[tree].take(node)
    if len(slot) and slot.min() == NOWHERE:
        on = slot != NOWHERE
        return hit[on], slot[on]
    return hit, slot


class Sums:
    """Of one tree, by feature and by node and bin: weights, and what they give with the label and
    with its square. Those two are the parts of a complex number, which are added at once.
    """

    def __init__(self, features: int, nodes: int) -> None:
        self.nodes = nodes
        self.weights = np.zeros((features, nodes * BINS))
        self.moments = np.zeros((features, nodes * BINS), complex)

    def __iadd__(self, other: Sums) -> Sums:
        self.weights += other.weights
        self.moments += other.moments
        return self

    def array(self) -> np.ndarray:
        """By feature, kind, node and bin."""
        kinds = np.stack([self.weights, self.moments.real, self.moments.imag], axis=1)
        return kinds.reshape(len(kinds), 3, self.nodes, BINS)


def _add(
    sums: dict[int, Sums], forest: Forest, trees: Sequence[int], used: Sequence[int],
    bins: np.ndarray, label: np.ndarray, draws: np.ndarray,
) -> None:
    """Add rows to the sums of their nodes, one after the other as Spark does."""
    columns = [np.ascontiguousarray(bins[:, f]) for f in used]
    for k, tree in enumerate(trees):
        if not sums[tree].nodes:
            continue
        drawn = np.ascontiguousarray(draws[:, k])
        hit, slot = _nodes(forest, tree, bins, np.flatnonzero(drawn))
        weight, y = drawn.take(hit).astype(float), label.take(hit)
        moment = np.empty(len(hit), complex)
        moment.real = weight * y
        moment.imag = moment.real * y
        cell = slot * BINS
        place = np.empty_like(cell)
        of = zip(sums[tree].weights, sums[tree].moments, columns, strict=True)
        for weights, moments, column in of:
            np.add(cell, column.take(hit), out=place)
            np.add.at(weights, place, weight)
            np.add.at(moments, place, moment)


def variance(count: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(count == 0, 0.0, (squares - (total * total) / count) / count)


def best_splits(
    sums: np.ndarray, splits: np.ndarray, impurity: np.ndarray | None, parent: np.ndarray | None
) -> tuple[np.ndarray, ...]:
    """Per node the first of its best splits: feature, bin, gain, impurity, and sums of the node,
    its left and its right side. ``sums`` is by feature, kind, node and bin.

    The root knows no sums of its own before; they are those of the first split's sides.
    """
    left = np.cumsum(sums, axis=-1)
    right = left[..., -1:] - left
    if parent is None:
        parent = (left[0, :, :, 0] + right[0, :, :, 0]).T
        impurity = variance(*parent.T)
    (lc, ls, lq), (rc, rs, rq) = left.swapaxes(0, 1), right.swapaxes(0, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        count = lc + rc
        gain = impurity[:, None] - lc / count * variance(lc, ls, lq) - rc / count * variance(rc, rs, rq)
        known = (np.arange(BINS) < splits[:, None])[:, None, :]
        gain = np.where(known & (lc >= 1) & (rc >= 1) & (gain >= 0), gain, INVALID)
    features, _, nodes, _ = sums.shape
    best = gain.transpose(1, 0, 2).reshape(nodes, features * BINS).argmax(axis=1)
    feature, at = np.divmod(best, BINS)
    n = np.arange(nodes)
    sides = (side[feature, :, n, at] for side in (left, right))
    return feature, at, gain[feature, n, at], impurity, parent, *sides


#: A tree of a level: what was found by place, and its sums for the next level.
LEVEL_SCHEMA = "group int, tree int, found binary, sums binary"


def _whole(summed: np.ndarray, rest: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Sums of all places: the rest is what siblings leave of the parents."""
    sibling, parent = rest.T
    left = before[:, :, parent] - summed[:, :, sibling]
    left[:, 1:] = np.where(left[:, :1] > 0, left[:, 1:], 0.0)  # no row, no remainder
    return np.concatenate([summed, left], axis=2)


def _grown(
    shared: Broadcast, groups: Sequence[range], splits: np.ndarray
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    width = len(splits)
    used = np.flatnonzero(splits) if splits.any() else np.arange(1)  # a root needs the sums of one

    def grow(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest: Forest = shared.value
        # Sums are kept by part and added in the order of the parts, as their rows come in any.
        parts: dict[int, dict[int, Sums]] = {}
        before: dict[int, np.ndarray] = {}
        group, trees = 0, range(0)
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column("group")[0].as_py()
            trees = groups[group]
            part = batch.column("part").to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(part)]
            for start, end in zip(starts, starts[1:], strict=False):
                run, p = batch.slice(start, end - start), int(part[start])
                if p < 0:  # sums of a tree
                    values = np.frombuffer(_bytes(run.column("bins")).tobytes())
                    before[-1 - p] = values.reshape(len(used), 3, -1, BINS)
                    continue
                sums = parts.setdefault(p, {})
                if not sums:
                    sums.update((t, Sums(len(used), forest.summed[t])) for t in trees)
                bins = _bytes(run.column("bins")).reshape(-1, width)
                label = np.frombuffer(_bytes(run.column("label")).tobytes())
                draws = _bytes(run.column("draws")).reshape(-1, len(trees))
                for i in range(0, len(label), CHUNK):
                    rows = slice(i, i + CHUNK)
                    _add(sums, forest, trees, used, bins[rows], label[rows], draws[rows])
        for t in trees:
            if not forest.summed[t]:
                continue
            total = reduce(iadd, (parts[p].pop(t) for p in sorted(parts))).array()
            if len(forest.rest[t]):
                total = _whole(total, forest.rest[t], before.pop(t))
            root = forest.level == 0
            feature, at, gain, impurity, *sides = best_splits(
                total,
                splits[used],
                None if root else forest.impurity[t],
                None if root else forest.parent[t],
            )
            found = np.column_stack([used[feature], at, gain, impurity, *sides])
            kept = b"" if forest.last else total.tobytes()
            columns = [[group], [t], [found.tobytes()], [kept]]
            types = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, types, strict=True)],
                ["group", "tree", "found", "sums"],
            )

    return grow


# --- the whole forest ----------------------------------------------------------------


@dataclass(slots=True)
class Node:
    sums: tuple[float, float, float]
    impurity: float
    gain: float = -1.0
    feature: int = -1
    split: int = -1

    @property
    def prediction(self) -> float:
        count, total, _ = self.sums
        return total / count if count else 0.0


def _scans(packed: DataFrame, before: DataFrame | None, groups: int) -> DataFrame:
    """One partition per group of trees: their sums of the level before, if any, and all rows."""

    def scan(k: int) -> DataFrame:
        draws = F.col(f"draws{k}").alias("draws")
        rows = packed.select(F.lit(k).alias("group"), "part", "bins", "label", draws)
        if before is not None:
            none = F.lit(b"")
            tree = (-1 - F.col("tree")).alias("part")
            sums = before.where(F.col("group") == k).select("group", tree, "sums", none, none)
            rows = sums.union(rows).toDF(*rows.columns)
        return rows.coalesce(1)

    return reduce(DataFrame.union, map(scan, range(groups)))


def _grow_levels(
    packed: DataFrame, groups: Sequence[range], edges: Sequence[np.ndarray], depth: int
) -> list[dict[int, Node]]:
    """Per tree its nodes by their number."""
    spark = packed.sparkSession
    trees, splits = groups[-1].stop, np.array([len(e) for e in edges])
    known: list[dict[int, Node]] = [{} for _ in range(trees)]
    summed = [[0] for _ in range(trees)]
    rest: list[list[tuple[int, int, int]]] = [[] for _ in range(trees)]
    size = 2 ** (depth + 1) - 1
    feature, split = np.full((trees, size), -1, np.int64), np.zeros((trees, size), np.int64)
    before = None
    for level in range(max(depth, 1)):
        if not any(summed):
            break
        slot = np.full((trees, size), NOWHERE, np.int64)
        for t, numbers in enumerate(summed):
            slot[t, numbers] = np.arange(len(numbers))
        places = [[*a, *(n for n, _, _ in b)] for a, b in zip(summed, rest, strict=True)]
        of = [[known[t][n] for n in numbers] if level else [] for t, numbers in enumerate(places)]
        forest = Forest(
            feature, split, slot,
            [len(numbers) for numbers in summed],
            [np.array([r[1:] for r in others], np.int64).reshape(-1, 2) for others in rest],
            [np.array([n.impurity for n in ns]) for ns in of],
            [np.array([n.sums for n in ns]).reshape(-1, 3) for ns in of],
            level,
            level + 1 >= depth,
        )
        shared = spark.sparkContext.broadcast(forest)
        grow = _grown(shared, groups, splits)
        with setting(spark, "spark.sql.unionOutputPartitioning", "false"):  # one task would read all
            scans = _scans(packed, before, len(groups))
            after = written(scans.mapInArrow(grow, LEVEL_SCHEMA), "forest-level")
        release(before)
        shared.destroy()
        before = after
        summed, rest = [[] for _ in range(trees)], [[] for _ in range(trees)]
        for tree, found in before.select("tree", "found").collect():
            numbers = places[tree]
            values = np.frombuffer(found).reshape(len(numbers), -1).tolist()
            for place, (number, (f, s, gain, impurity, *sums)) in enumerate(zip(numbers, values, strict=True)):
                node = known[tree][number] = Node(tuple(sums[:3]), impurity)
                if gain == INVALID:
                    node.impurity = -1.0
                if gain <= 0 or level == depth:
                    continue
                node.gain, node.feature, node.split = gain, int(f), int(s)
                feature[tree, number], split[tree, number] = node.feature, node.split
                grows = []
                for child, own in ((2 * number + 1, sums[3:6]), (2 * number + 2, sums[6:9])):
                    side = Node(tuple(own), float(variance(*map(np.float64, own))))
                    known[tree][child] = side
                    if level + 1 < depth and abs(side.impurity) >= EPSILON:
                        grows.append((own[0], child))
                for _, child in sorted(grows)[:1]:
                    summed[tree].append(child)
                for _, child in sorted(grows)[1:]:
                    rest[tree].append((child, len(summed[tree]) - 1, place))
    release(before)
    return known


def _pruned(nodes: dict[int, Node], edges: Sequence[np.ndarray]) -> list[dict]:
    """A tree as a saved model has it: numbered in preorder, equal leaves of a node joined."""
    listed: list[dict] = []

    def leaf(number: int) -> bool:
        node = nodes[number]
        if node.feature < 0:
            return True
        sides = [2 * number + 1, 2 * number + 2]
        if all([leaf(side) for side in sides]):
            left, right = (nodes[side].prediction for side in sides)
            if left == right:
                node.feature = -1
                return True
        return False

    def add(number: int) -> int:
        node, place = nodes[number], len(listed)
        inner = node.feature >= 0
        row = {
            "id": place,
            "prediction": node.prediction,
            "impurity": node.impurity,
            "impurityStats": list(node.sums),
            "rawCount": int(node.sums[0]),
            "gain": node.gain if inner else -1.0,
            "leftChild": -1,
            "rightChild": -1,
            "split": {
                "featureIndex": node.feature,
                "leftCategoriesOrThreshold": [float(edges[node.feature][node.split])] if inner else [],
                "numCategories": -1,
            },
        }
        listed.append(row)
        if inner:
            row["leftChild"] = add(2 * number + 1)
            row["rightChild"] = add(2 * number + 2)
        return place

    leaf(0)
    add(0)
    return listed


NODE_SCHEMA = pa.schema(
    {
        "treeID": pa.int32(),
        "nodeData": pa.struct(
            {
                "id": pa.int32(),
                "prediction": pa.float64(),
                "impurity": pa.float64(),
                "impurityStats": pa.list_(pa.float64()),
                "rawCount": pa.int64(),
                "gain": pa.float64(),
                "leftChild": pa.int32(),
                "rightChild": pa.int32(),
                "split": pa.struct(
                    {
                        "featureIndex": pa.int32(),
                        "leftCategoriesOrThreshold": pa.list_(pa.float64()),
                        "numCategories": pa.int32(),
                    }
                ),
            }
        ),
    }
)


def _model(
    spark: SparkSession, learner: RandomForestRegressor, nodes: pa.Table, width: int
) -> RandomForestRegressionModel:
    """The nodes as Spark's model: they replace those of a model of one row in its saved form."""
    row = [(Vectors.dense([0.0] * width), 0.0)]
    alone = spark.createDataFrame(row, [learner.getFeaturesCol(), learner.getLabelCol()])
    path = shared_folder(spark, "forest")
    try:
        learner.fit(alone).write().save(path)
        data = spark.createDataFrame(nodes)
        data.write.mode("overwrite").parquet(f"{path}/data")
        return RandomForestRegressionModel.load(path)
    finally:
        delete(spark, path)


def fit_forest(
    rows: DataFrame, features: Sequence[str], learner: RandomForestRegressor, total: int
) -> RandomForestRegressionModel:
    """What ``learner`` fits on these ``total`` rows, in their partitions and order.

    Of the learner's parameters, columns, ``numTrees``, ``maxDepth`` and ``seed`` may be set, and
    ``featureSubsetStrategy`` has to be all.
    """
    if not total:
        raise ValueError("there is no row to train on")
    if total <= FEW_ROWS or learner.getMaxDepth() > DEEPEST:
        assembler = VectorAssembler(inputCols=list(features), outputCol=learner.getFeaturesCol())
        return learner.fit(assembler.transform(rows))
    spark = ship_package(rows.sparkSession)
    trees, depth, seed = learner.getNumTrees(), learner.getMaxDepth(), learner.getSeed()
    numbers = [F.col(f"`{c}`").cast("double") for c in (*features, learner.getLabelCol())]
    plain = rows.select(*(n.alias(f"v{i}") for i, n in enumerate(numbers)))
    recorded = plain.mapInArrow(_record, "record binary")
    binary = spark._jvm.org.apache.spark.sql.Encoders.BINARY()
    # One chain of tasks for both passes: the second one finds the dealt rows of the first.
    records = getattr(recorded._jdf, "as")(binary).rdd()

    needed = max(BINS * BINS, 10000)
    share = needed / total if needed < total else 1.0
    sampled = records
    if share < 1.0:
        random = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        sampled = records.toJavaRDD().sample(False, share, random).rdd()
    sample = DataFrame(spark._jsparkSession.createDataset(sampled, binary).toDF(), spark).collect()
    values = np.frombuffer(b"".join(bytes(r[0]) for r in sample)).reshape(-1, len(numbers))
    edges = thresholds(values[:, :-1], total, share)

    tasks = min(trees, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    each = -(-trees // tasks)
    groups = [range(t, min(t + each, trees)) for t in range(0, trees, each)]
    schema = ", ".join(
        ["part int, bins binary, label binary", *(f"draws{k} binary" for k in range(len(groups)))]
    )
    drawn = _drawn(spark, records, trees, seed)
    packed = written(drawn.mapInArrow(_packed(edges, groups), schema), "forest-rows")
    try:
        known = _grow_levels(packed, groups, edges, depth)
    finally:
        release(packed)
    nodes = pa.concat_tables(
        pa.Table.from_pylist([{"treeID": t, "nodeData": n} for n in _pruned(tree, edges)], NODE_SCHEMA)
        for t, tree in enumerate(known)
    )
    return _model(spark, learner, nodes, len(features))
