"""Spark ML's ``GBTClassifier`` (logistic loss, variance, all rows and features in each tree) fitted over blocks of binned rows.

``GBTClassifier`` passes over one object per row, with an integer per feature, for each level of each tree.  Here a block holds the
bins of many rows as bytes, a column after the other, with the rows' predictions and residuals; a pass walks the blocks
down the tree so far and sums count, residual and its square by (node, column, bin) in NumPy.  Three things are left out that
change no split: columns that have a single bin, columns equal to an earlier one in every row (the earlier one wins the tie), and,
below a node of more than ``DIRECT`` rows, the sums of the child with more rows, which are the node's less the other child's.

Sample, thresholds, bins, gains, ties, early leaves, pruning and tree weights follow Spark's learner step by step, down to
the order of the additions, so that rows that fit into one block give its trees to the last bit.  The result is
written in Spark's format and read back: a ``GBTClassificationModel`` like any other.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shared_path

#: Rows of a block; rows up to which both children of a node are summed up themselves; rows from which thresholds are taken.
ROWS, DIRECT, SAMPLE = 1 << 16, 1 << 16, 10_000
#: Partitions up to which their sums go straight to the driver.
STRAIGHT = 16
EPSILON = 2.0 ** -52


# ---- thresholds and bins ------------------------------------------------------------------
def thresholds(values: np.ndarray, n: int, max_bins: int) -> np.ndarray:
    """Split points of one column from its sampled values, out of ``n`` rows: midpoints of neighbouring values, all of them or those
    nearest to equal shares.  Zeros are not counted but taken to be the rest, as Spark does."""
    share = min(1.0, max(max_bins * max_bins, SAMPLE) / n)
    value, count = np.unique(values[values != 0.0], return_counts=True)
    if not len(value):
        return np.empty(0)
    seen, expected = int(count.sum()), share * n
    weight = count.astype(float)
    if expected - seen > EPSILON * seen * 100:
        at = int(np.searchsorted(value, 0.0))
        value, weight = np.insert(value, at, 0.0), np.insert(weight, at, expected - seen)
    most = min(max_bins, n) - 1
    middle = (value[:-1] + value[1:]) / 2.0
    if len(middle) <= most:
        return middle
    stride, upto, out = expected / (most + 1), np.cumsum(weight), []
    target = stride
    for k in range(len(middle)):
        if abs(upto[k] - target) < abs(upto[k + 1] - target):
            out.append(middle[k])
            target += stride
    return np.array(out)


def sampled(df: DataFrame, columns: Sequence[str], n: int, max_bins: int, seed: int) -> np.ndarray:
    """The rows that Spark's learner takes its thresholds from: about ``SAMPLE`` of them, all if there are no more."""
    spark, need = df.sparkSession, max(max_bins * max_bins, SAMPLE)
    rows = df.select(*columns)
    if need < n:
        draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        jrows = rows._jdf.javaRDD().sample(False, need / n, draw)
        rows = DataFrame(spark._jsparkSession.createDataFrame(jrows, rows._jdf.schema()), spark)
    return rows.toPandas().to_numpy(dtype=float)


def bin_of(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Bins as Spark finds them.  Midpoints of adjacent doubles may be equal; a value that is one of several equal thresholds gets the
    bin of the one that the JVM's binary search meets first."""
    at = np.searchsorted(cut, values)
    if len(cut) and (cut[1:] == cut[:-1]).any():
        met = np.arange(len(cut) + 1)
        for k, v in enumerate(cut):
            low, high = 0, len(cut) - 1
            while cut[mid := (low + high) // 2] != v:
                low, high = (mid + 1, high) if cut[mid] < v else (low, mid - 1)
            met[k] = mid
        at = np.where(np.append(cut, np.nan)[at] == values, met[at], at)
    return at


def _blocks(batches: Iterator[pa.RecordBatch], columns: list[str], cuts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(bins by column, class as -1 or 1) of about ``ROWS`` rows at a time."""
    def block(held):
        t = pa.Table.from_batches(held)
        bins = np.empty((len(cuts), t.num_rows), np.uint8)
        for k, (c, cut) in enumerate(zip(columns, cuts)):
            v = t[c].to_numpy()
            if not np.isfinite(v).all():
                raise ValueError(f"{c} must not be NaN or infinite")
            bins[k] = bin_of(v, cut)
        sign = (t["label"].to_numpy() * 2 - 1).astype(np.float64)
        return pa.record_batch({"bins": pa.array([bins.tobytes()], pa.binary()), "sign": pa.array([sign.tobytes()], pa.binary())})

    held: list[pa.RecordBatch] = []
    for b in batches:
        if b.num_rows:
            held.append(b)
        if sum(x.num_rows for x in held) >= ROWS:
            yield block(held)
            held = []
    if held:
        yield block(held)


def _equal(bins: bytes, n: int) -> tuple[int, ...]:
    """For each column of a block the first one with the same bins."""
    first: dict[bytes, int] = {}
    return tuple(first.setdefault(bins[k:k + n], k // n) for k in range(0, len(bins), n))


def _both(a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
    """For each column the first one that is equal to it in both."""
    first: dict[tuple[int, int], int] = {}
    return tuple(first.setdefault(x, k) for k, x in enumerate(zip(a, b)))


# ---- one tree -----------------------------------------------------------------------------
@dataclass
class Tree:
    """Nodes in order of creation; a leaf has column -1 and itself as both children."""

    column: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    stats: list[tuple[float, float, float]] = field(default_factory=list)  # rows, sum of residuals, of their squares
    impurity: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, stats, impurity: float) -> int:
        k = len(self.column)
        for have, x in ((self.column, -1), (self.cut, 0), (self.left, k), (self.right, k),
                        (self.stats, tuple(map(float, stats))), (self.impurity, float(impurity)), (self.gain, -1.0)):
            have.append(x)
        return k

    def split(self, k: int, column: int, cut: int, left: int, right: int, gain: float) -> None:
        self.column[k], self.cut[k], self.left[k], self.right[k], self.gain[k] = column, cut, left, right, gain

    def prediction(self, k: int) -> float:
        return self.stats[k][1] / self.stats[k][0]

    def steps(self, bins: int) -> tuple[np.ndarray, np.ndarray]:
        """(column of a node, next node by node and bin), small arrays to hand to tasks."""
        low = np.arange(bins) <= np.array(self.cut)[:, None]
        return np.maximum(self.column, 0).astype(np.int16), np.where(low, np.array(self.left)[:, None], np.array(self.right)[:, None]).astype(np.int16 if len(self.column) < 1 << 15 else np.int32)


class Walk:
    """Takes the rows of blocks down a tree; what depends on the tree alone is laid out once."""

    def __init__(self, steps: tuple[np.ndarray, np.ndarray], depth: int):
        self.column, self.depth, self.bins = steps[0].astype(np.intp), depth, steps[1].shape[1]
        self.next = steps[1].astype(np.intp).ravel()

    def __call__(self, bins: np.ndarray) -> np.ndarray:
        """The node of each row after ``depth`` steps; ``bins``: (columns, rows)."""
        n = bins.shape[1]
        if not self.depth:
            return np.zeros(n, np.intp)
        node = self.next[:self.bins].take(bins[self.column[0]])
        start, rows, flat = self.column * n, np.arange(n), bins.ravel()
        at, bin_ = np.empty(n, np.intp), np.empty(n, bins.dtype)
        for _ in range(self.depth - 1):
            np.take(start, node, out=at, mode="clip")
            np.add(at, rows, out=at)
            np.take(flat, at, out=bin_, mode="clip")
            np.multiply(node, self.bins, out=at)
            np.add(at, bin_, out=at)
            np.take(self.next, at, out=node, mode="clip")
        return node


def _unpacked(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bins, pred, residual = block
    pred, residual = np.frombuffer(pred), np.frombuffer(residual)
    return np.frombuffer(bins, np.uint8).reshape(-1, len(pred)), pred, residual


def _sums(blocks, steps, depth: int, slot: np.ndarray, slots: int, sizes: list[int]) -> Iterator[np.ndarray]:
    """Of a partition: rows, residuals and squares by (column, slot, bin), in one array; ``slot``: of a node, ``slots`` if none."""
    walk, total, buf = Walk(steps, depth), None, np.empty(0, np.intp)
    for block in blocks:
        bins, _, residual = _unpacked(block)
        at = slot.take(walk(bins))
        rows = np.flatnonzero(at < slots)
        whole = len(rows) == len(at)
        if not whole:
            at, residual = at.take(rows), residual.take(rows)
        square = residual * residual
        if len(buf) < len(at):
            buf = np.empty(len(at), np.intp)
        to, parts = buf[:len(at)], []
        for col, size in zip(bins, sizes):
            np.multiply(at, size, out=to)
            np.add(to, col if whole else col.take(rows), out=to)
            parts += [np.bincount(to, minlength=slots * size), np.bincount(to, residual, slots * size), np.bincount(to, square, slots * size)]
        got = np.concatenate(parts)
        total = got if total is None else np.add(total, got, out=total)
    if total is not None:
        yield total


def _gathered(data, make) -> np.ndarray:
    parts = data.mapPartitions(make)
    return parts.treeReduce(np.add) if data.getNumPartitions() > STRAIGHT else reduce(np.add, parts.collect())


def _variance(rows, total, squares):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(rows == 0, 0.0, (squares - (total * total) / rows) / rows)


def _grown(data, cuts: list[np.ndarray], depth: int) -> Tree:
    """The tree over the residuals: level by level, the best split of each node from its sums by column and bin.  Rows then go by the
    threshold's value, as in Spark: left in all bins that end at an equal one."""
    sizes, last = [len(c) + 1 for c in cuts], [np.searchsorted(c, c, "right") - 1 for c in cuts]
    tree, active, above, place = Tree(), [0], None, {}
    pairs: list[tuple[int, int]] = []  # children that are split further, with their parent's place in ``above``
    bins = max(sizes)
    for level in range(depth):
        if level == 0:
            summed, rest = [0], []
        else:
            summed, rest, of = [], [], {}
            for k, parent in pairs:
                of.setdefault(parent, []).append(k)
            for parent, kids in of.items():
                rows = [tree.stats[k][0] for k in kids]
                if len(kids) == 2 and sum(rows) > DIRECT:
                    small, large = kids if rows[0] <= rows[1] else kids[::-1]
                    summed.append(small)
                    rest.append((large, small, parent))
                else:
                    summed += kids
            active = summed + [x[0] for x in rest]
        place = {k: i for i, k in enumerate(active)}
        slot = np.full(max(1, len(tree.column)), len(summed), np.intp)
        slot[summed] = np.arange(len(summed))
        steps = tree.steps(bins) if level else (np.zeros(1, np.int16), np.zeros((1, bins), np.int16))
        flat = _gathered(data, lambda it, steps=steps, level=level, slot=slot, k=len(summed): _sums(it, steps, level, slot, k, sizes))
        sums, at = [], 0
        for j, size in enumerate(sizes):
            own = flat[at:at + 3 * len(summed) * size].reshape(3, len(summed), size)
            at += own.size
            if rest:
                other = above[j][:, [p for _, _, p in rest]] - own[:, [place[s] for _, s, _ in rest]]
                other[:, other[0] == 0] = 0.0
                own = np.concatenate([own, other], axis=1)
            sums.append(own)
        above = sums
        if level == 0:
            upto = sums[0].cumsum(axis=2)
            low = upto[:, 0, 0]
            stats = low + (upto[:, 0, -1] - low)
            tree.add(stats, _variance(*stats))
        impurity = np.array([tree.impurity[k] for k in active])[:, None]
        # best[i] of a node: gain, column, cut, sums on the left and on the right
        best = np.full(len(active), -np.inf)
        column, cut = np.full(len(active), -1), np.zeros(len(active), int)
        sides = np.zeros((2, 3, len(active)))
        one = np.arange(len(active))
        for j, x in enumerate(sums):
            if x.shape[2] < 2:
                continue
            upto = x.cumsum(axis=2)
            low = upto[:, :, :-1]
            high = upto[:, :, -1:] - low
            both = low[0] + high[0]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = impurity - low[0] / both * _variance(*low) - high[0] / both * _variance(*high)
            gain[(low[0] < 1) | (high[0] < 1) | ~(gain >= 0.0)] = -np.inf
            k = gain.argmax(axis=1)
            won = gain[one, k] > best
            best[won], column[won], cut[won] = gain[one, k][won], j, k[won]
            sides[0][:, won], sides[1][:, won] = low[:, one, k][:, won], high[:, one, k][:, won]
        pairs = []
        for i in sorted(range(len(active)), key=active.__getitem__):
            k = active[i]
            if best[i] == -np.inf:
                tree.impurity[k] = -1.0  # no valid split, which Spark notes so
            elif best[i] > 0:
                kids = [tree.add(s, _variance(*s)) for s in (sides[0][:, i], sides[1][:, i])]
                tree.split(k, int(column[i]), int(last[column[i]][cut[i]]), *kids, float(best[i]))
                pairs += [(c, i) for c in kids if level + 1 < depth and abs(tree.impurity[c]) >= EPSILON]
        if not pairs:
            break
    return tree


# ---- the loop over trees ----------------------------------------------------------------------
def _exp(x: np.ndarray) -> np.ndarray:
    """exp as fdlibm has it, which the JVM uses: NumPy's may differ in the last bit."""
    high, low = 6.93147180369123816490e-01, 1.90821492927058770002e-10
    size = (np.abs(x).view(np.int64) >> 32).astype(np.int32)
    k = np.where(size < 0x3FF0A2B2, np.sign(x), np.trunc(1.44269504088896338700 * x + np.copysign(0.5, x)))
    k = np.where(size > 0x3FD62E42, np.clip(k, -2000, 2000), 0.0)
    hi, lo = x - k * high, k * low
    r = hi - lo
    t = r * r
    c = r - t * (1.66666666666666019037e-01 + t * (-2.77777777770155933842e-03 + t * (6.61375632143793436117e-05 + t * (
        -1.65339022054652515390e-06 + t * 4.13813679705723846039e-08))))
    return np.where(size < 0x3E300000, 1.0 + x, np.ldexp(1.0 - ((lo - (r * c) / (2.0 - c)) - hi), k.astype(np.int32)))


def _moved(blocks, steps, depth: int, values: np.ndarray, weight: float) -> Iterator[tuple[bytes, bytes, bytes]]:
    """The blocks with a tree's predictions added, and the residuals that are left."""
    walk = Walk(steps, depth)
    for block in blocks:
        bins, pred, residual = _unpacked(block)
        sign = np.copysign(1.0, residual)  # a residual has the sign of the class
        pred = pred + values.take(walk(bins)) * weight
        with np.errstate(over="ignore"):
            residual = 4.0 * sign / (1.0 + _exp(2.0 * sign * pred))
        yield block[0], pred.tobytes(), residual.tobytes()


def _instead_of(spark, old: str | None, new: str | None) -> str | None:
    """``new``, with the checkpoint ``old`` removed: no blocks are built on it any more."""
    if old:
        at = spark._jvm.org.apache.hadoop.fs.Path(old)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return new


def boosted(df: DataFrame, stage: GBTClassifier, columns: Sequence[str]) -> tuple[list[Tree], list[np.ndarray], list[int]]:
    """(trees, thresholds of their columns, feature numbers of their columns)."""
    spark, columns = df.sparkSession, list(columns)
    depth, rate, max_bins = stage.getMaxDepth(), stage.getStepSize(), stage.getMaxBins()
    if max_bins > 256:
        raise ValueError("a bin is held in a byte: at most 256 bins")
    label = F.col(stage.getLabelCol()).cast("double")
    df = df.select(*[F.col(c).cast("double").alias(c) for c in columns], F.when(label.isin(0.0, 1.0), label).otherwise(
        F.raise_error(F.concat(F.lit("Labels must be in {0, 1}, but got "), F.coalesce(label.cast("string"), F.lit("null"))))).alias("label"))
    n = df.count()
    if not n:
        raise ValueError("there are no rows to fit a model to")
    sample = sampled(df, columns, n, max_bins, stage.getSeed())
    cuts = [thresholds(sample[:, k], n, max_bins) for k in range(len(columns))]
    used = [k for k, c in enumerate(cuts) if len(c)] or [0]
    names, own = [columns[k] for k in used], [cuts[k] for k in used]
    tasks = max(1, min(spark.sparkContext.defaultParallelism, -(-n // ROWS)))
    binned = df.select(*names, "label").mapInArrow(lambda it: _blocks(it, names, own), "bins binary, sign binary").repartition(tasks)
    level = StorageLevel.MEMORY_AND_DISK
    base = binned.rdd.map(lambda b: (bytes(b.bins), bytes(b.sign))).persist(level)
    alike = base.map(lambda b: _equal(b[0], len(b[1]) // 8)).reduce(_both)
    kept = sorted(set(alike))
    used, cuts = [used[k] for k in kept], [own[k] for k in kept]
    bins = max(map(len, cuts)) + 1

    def begun(b):
        sign = np.frombuffer(b[1])
        return np.frombuffer(b[0], np.uint8).reshape(-1, len(sign))[kept].tobytes(), bytes(8 * len(sign)), b[1]

    ensure_checkpoint_dir(spark)
    data, before, trees, saved = base.map(begun).persist(level), base, [], None
    for t in range(stage.getMaxIter()):
        trees.append(tree := _grown(data, cuts, depth))
        before.unpersist()
        if data.isCheckpointed():
            saved = _instead_of(spark, saved, data.getCheckpointFile())
        if t + 1 < stage.getMaxIter():
            steps, weight = tree.steps(bins), rate if t else 1.0
            values = np.array([tree.prediction(k) for k in range(len(tree.column))])
            before, data = data, data.mapPartitions(
                lambda it, steps=steps, values=values, weight=weight: _moved(it, steps, depth, values, weight)).persist(level)
            if (t + 1) % stage.getCheckpointInterval() == 0:
                data.checkpoint()
    data.unpersist()
    _instead_of(spark, saved, None)
    return trees, cuts, used


# ---- Spark's model ------------------------------------------------------------------------------
NODE = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
                  ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                  ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                                       ("numCategories", pa.int32())]))])


def node_rows(tree: Tree, cuts: list[np.ndarray], used: list[int]) -> list[dict]:
    """The tree's nodes as Spark numbers and writes them, a node before its left and then its right branch; two leaves
    of one parent with equal predictions are one."""
    def leaf(k):
        return tree.column[k] < 0 or (leaf(tree.left[k]) and leaf(tree.right[k]) and value(tree.left[k]) == value(tree.right[k]))

    def value(k):
        return tree.prediction(k) if tree.column[k] < 0 else value(tree.left[k])

    rows: list[dict] = []

    def put(k: int) -> int:
        rows.append(row := {"id": len(rows), "prediction": tree.prediction(k), "impurity": tree.impurity[k], "impurityStats": list(tree.stats[k]),
                            "rawCount": int(tree.stats[k][0]), "gain": -1.0, "leftChild": -1, "rightChild": -1,
                            "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}})
        if leaf(k):
            row["prediction"] = value(k)
        else:
            row["split"] = {"featureIndex": used[tree.column[k]], "leftCategoriesOrThreshold": [float(cuts[tree.column[k]][tree.cut[k]])], "numCategories": -1}
            row |= {"gain": tree.gain[k], "leftChild": put(tree.left[k]), "rightChild": put(tree.right[k])}
        return row["id"]

    put(0)
    return rows


def fitted(df: DataFrame, stage: GBTClassifier, columns: Sequence[str]) -> GBTClassificationModel:
    """``stage`` fitted to the rows of ``df``, with ``columns`` as its features: the model that ``stage.fit`` returns on their vectors."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, "gbt")
    trees, cuts, used = boosted(df, stage, columns)
    rows = [(t, x) for t, tree in enumerate(trees) for x in node_rows(tree, cuts, used)]

    def params(keep=lambda name: True):
        return {name: {p.name: v for p, v in have.items() if keep(p.name)} for name, have in (("paramMap", stage._paramMap), ("defaultParamMap", stage._defaultParamMap))}

    def noted(kind: str, uid: str, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid, **more})

    common = {"cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB",
              "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed"}
    one = [noted("regression.DecisionTreeRegressionModel", f"{stage.uid}_{t}", **params(common.__contains__)) for t in range(len(trees))]
    spark.createDataFrame([(noted("classification.GBTClassificationModel", stage.uid, numFeatures=len(columns), numTrees=len(trees), **params()),)],
                          "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(pa.table({"_1": pa.array(range(len(trees)), pa.int32()), "_2": one, "_3": [1.0] + [stage.getStepSize()] * (len(trees) - 1)})
                          ).coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(pa.table({"treeID": pa.array([t for t, _ in rows], pa.int32()), "nodeData": pa.array([x for _, x in rows], NODE)})
                          ).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def saved_nodes(model: GBTClassificationModel) -> DataFrame:
    """The model's own node table (treeID, nodeData), written to the shared folder and read back as rows."""
    spark = SparkSession.getActiveSession()
    path = shared_path(spark, "trees")
    model.save(path)
    return spark.read.parquet(f"{path}/data")


def probability(model: GBTClassificationModel, columns: Sequence[str]):
    """Column: the model's probability of class 1, from ``columns`` as its features (no categories).  Whole batches walk
    down the trees by the bins of the model's own thresholds."""
    # the model's size bounds these rows, not the scored table's
    nodes = saved_nodes(model).select("treeID", "nodeData.*").select(
        "treeID", "id", "prediction", "leftChild", "rightChild", F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold")).toPandas().sort_values(["treeID", "id"])
    inner = nodes[nodes.leftChild >= 0]
    used = sorted(set(inner.feature)) or [0]
    cuts = [np.unique(inner.threshold[inner.feature == f]) for f in used]
    bins, trees = max(map(len, cuts)) + 1, []
    for (_, x), weight in zip(nodes.groupby("treeID"), model.treeWeights):
        at, leaf = x.id.to_numpy(), x.leftChild.to_numpy() < 0
        column = np.where(leaf, 0, np.searchsorted(used, x.feature))
        cut = np.array([0 if end else np.searchsorted(cuts[c], v) for end, c, v in zip(leaf, column, x.threshold)])
        trees.append((column, cut, np.where(leaf, at, x.leftChild), np.where(leaf, at, x.rightChild), x.prediction.to_numpy() * weight))
    depth = [t.depth for t in model.trees]
    return F.pandas_udf(_scorer(trees, depth, cuts, bins), "double")(F.struct(*[F.col(columns[f]).alias(f"x{k}") for k, f in enumerate(used)]))


def _scorer(trees, depth, cuts, bins):
    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        walks = []
        for (column, cut, left, right, _), deep in zip(trees, depth):
            low = np.arange(bins) <= cut[:, None]
            walks.append(Walk((column, np.where(low, left[:, None], right[:, None])), deep))
        for b in batches:
            at = np.stack([np.searchsorted(c, b[f"x{k}"].to_numpy()) for k, c in enumerate(cuts)]).astype(np.uint16)
            margin = np.zeros(len(b))
            for walk, (*_, value) in zip(walks, trees):
                margin += value.take(walk(at))
            with np.errstate(over="ignore"):
                yield pd.Series(1.0 - 1.0 / (1.0 + np.exp(2.0 * margin)))
    return scores
