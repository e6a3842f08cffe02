"""Gradient-boosted regression trees on binned features, grown level by level.

Each level of a tree is one pass over the rows that adds up gradients per (node, feature, bin);
only those sums are needed to pick the splits. Spark ML's trainer has neither column
sampling per tree nor an L2 term; this one has both.

The rows are kept as blocks of bytes in an RDD: a pass is arithmetic on whole blocks with state
(the predictions so far) that goes from tree to tree, which columns of a DataFrame would carry
as an ever longer expression.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratacast.session import shared_dir

BINS = 256
# Most rows of a block, and those that one task grows trees from alone: 300 trees of depth 4 take it
# half a minute. More rows are dealt to all cores, in tasks of up to so many times as many rows: a
# row takes some 30 bytes, so the largest task 126 MB. Larger tasks have less overhead in a pass.
BLOCK_ROWS, TASK_ROWS, LARGEST_TASK = 1 << 14, 1 << 18, 16
# Trees after which predictions so far are kept, and the number of such states after which
# one is written to the shared folder, which cuts the lineage: in one task, and by passes.
IN_TASK, BY_PASSES = (25, 6), (2, 12)
# Up to so many tasks send their sums straight to the driver; more are added up in between.
FLAT_TASKS = 64
# Gradients are counted in steps of their largest size over this, so sums are exact integers
# and the same in whatever order blocks are added.
STEPS = 1 << 30
_PRIME = (1 << 31) - 1
_LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Settings:
    trees: int
    depth: int
    rate: float
    row_fraction: float
    column_fraction: float
    seed: int
    penalty: float = 1.0
    least_rows: float = 1.0


@dataclass
class Tree:
    """Nodes in heap order: node k's children are 2k + 1 (value < threshold) and 2k + 2."""

    feature: np.ndarray  # -1: a leaf
    cut: np.ndarray  # bin of the threshold: lower bins go left
    threshold: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        ints, floats = np.full(n, -1, np.int32), np.zeros(n)
        return cls(ints, ints.copy(), floats, floats.copy(), floats.copy())

    def leaves(self, columns: np.ndarray, limits: np.ndarray, depth: int) -> np.ndarray:
        """The node that each row ends in, or has reached at ``depth``.

        ``columns`` holds a row per feature; it is compared with ``limits``, the cuts for bins
        or the thresholds for values.
        """
        n = columns.shape[1]
        at = np.zeros(n, np.int64)
        if not n:
            return at
        rows, flat = np.arange(n), np.ascontiguousarray(columns).reshape(-1)
        # Where a node's feature begins in the flat columns, and the nodes left and right of
        # it: for a leaf, itself.
        begin = np.maximum(self.feature, 0).astype(np.int64) * n
        nodes = np.arange(len(self.feature))
        sides = np.stack([2 * nodes + 1, 2 * nodes + 2], axis=1)
        sides = np.where((self.feature >= 0)[:, None], sides, nodes[:, None]).reshape(-1)
        for _ in range(depth):
            place = begin.take(at)
            place += rows
            right = flat.take(place) >= limits.take(at)
            at *= 2
            at += right
            at = sides.take(at)
        return at


@dataclass
class BoostedTrees:
    """A trained model: the prediction is ``base`` plus the value of each tree's leaf."""

    features: list[str]
    base: float
    depth: int
    trees: list[Tree] = field(default_factory=list)

    def predict(self, columns: np.ndarray) -> np.ndarray:
        found = np.full(columns.shape[1], self.base)
        for tree in self.trees:
            found += tree.value[tree.leaves(columns, tree.threshold, self.depth)]
        return found

    def transform(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` with the prediction; null where a feature is null."""

        @F.pandas_udf("double")
        def predicted(*columns):
            values = np.array([c.to_numpy(np.float64, na_value=np.nan) for c in columns])
            found = self.predict(values)
            found[np.isnan(values).any(axis=0)] = np.nan
            return pd.Series(found)

        return df.withColumn(name, predicted(*[F.col(f) for f in self.features]))

    def importance(self) -> dict[str, float]:
        """Mean gain of each feature's splits, as shares that sum to one."""
        gains = np.zeros(len(self.features))
        splits = np.zeros(len(self.features))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(gains, tree.feature[inner], tree.gain[inner])
            np.add.at(splits, tree.feature[inner], 1)
        means = gains / np.maximum(splits, 1)
        total = means.sum() or 1.0
        return dict(zip(self.features, (means / total).tolist()))

    _SCHEMA = """tree int, node int, feature string, cut int, threshold double, value double,
        gain double, base double, depth int, features array<string>"""

    def save(self, spark: SparkSession, folder: str) -> None:
        """One row per node, and one without a tree for what all trees share."""
        shared = (self.base, self.depth, self.features)
        rows = [(-1, 0, None, -1, 0.0, 0.0, 0.0, *shared)]
        for k, tree in enumerate(self.trees):
            for n in range(len(tree.feature)):
                f = int(tree.feature[n])
                name = self.features[f] if f >= 0 else None
                numbers = [float(x[n]) for x in (tree.threshold, tree.value, tree.gain)]
                rows.append((k, n, name, int(tree.cut[n]), *numbers, None, None, None))
        spark.createDataFrame(rows, self._SCHEMA).coalesce(1).write.mode("overwrite").parquet(folder)

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> BoostedTrees:
        rows = sorted(spark.read.parquet(folder).collect(), key=lambda r: (r["tree"], r["node"]))
        head, nodes = rows[0], rows[1:]
        model = cls(list(head["features"]), head["base"], head["depth"])
        size = 2 ** (model.depth + 1) - 1
        places = {name: k for k, name in enumerate(model.features)}
        for low in range(0, len(nodes), size):
            own = nodes[low : low + size]
            feature = np.array([places.get(r["feature"], -1) for r in own], np.int32)
            cut = np.array([r["cut"] for r in own], np.int32)
            floats = [np.array([r[c] for r in own]) for c in ("threshold", "value", "gain")]
            model.trees.append(Tree(feature, cut, *floats))
        return model


def cut_points(train: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Up to BINS - 1 different quantiles of each feature, from one pass that merges sketches."""
    shares = [k / BINS for k in range(1, BINS)]
    found = train.agg(
        *[F.percentile_approx(f, shares, F.lit(10_000)).alias(f"q{k}") for k, f in enumerate(features)]
    ).first()
    return [np.unique(np.array(q if q is not None else [], np.float64)) for q in found]


# A block: bins (a row of bytes per feature), targets, numbers that rows are drawn by, and
# predictions so far.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
# The columns of a tree, and two numbers that say which rows are drawn for it.
Drawn = tuple[np.ndarray, int, int]


def _blocks(train: DataFrame, features: Sequence[str], target: str, cuts, tasks: int) -> RDD:
    """The rows as blocks; predictions are not set yet."""
    own = [F.col(f).cast("double") for f in features]
    # A row's own number depends on its values only, not on where it lies.
    draw = F.pmod(F.xxhash64(*train.columns), F.lit(_PRIME)).alias("draw")
    rows = train.select(*own, F.col(target).cast("double").alias("target"), draw)

    most = BLOCK_ROWS

    def binned(batches: Iterator[pa.RecordBatch]):
        for batch in (b.slice(k, most) for b in batches for k in range(0, b.num_rows, most)):
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(cuts))]
            bins = np.array([np.searchsorted(c, x, "right") for c, x in zip(cuts, columns)], np.uint8)
            target, draw = (batch.column(k).to_numpy() for k in (len(cuts), len(cuts) + 1))
            parts = [bins.tobytes(), target.tobytes(), draw.astype(np.uint32).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([p]) for p in parts], ["b", "t", "d"])

    own_bins = len(cuts)

    def block(row) -> Block:
        target, draw = np.frombuffer(row["t"]), np.frombuffer(row["d"], np.uint32)
        bins = np.frombuffer(row["b"], np.uint8).reshape(own_bins, len(target))
        return bins, target, draw, np.zeros(len(target))

    # Blocks and not rows are dealt, so that all tasks get the same share of them.
    return rows.mapInArrow(binned, "b binary, t binary, d binary").repartition(tasks).rdd.map(block)


def _drawn(settings: Settings, tree: int, features: int) -> Drawn:
    rng = np.random.default_rng((settings.seed, tree))
    n = max(1, round(settings.column_fraction * features))
    columns = np.sort(rng.choice(features, n, replace=False))
    return columns, int(rng.integers(1, _PRIME)), int(rng.integers(0, _PRIME))


@dataclass(frozen=True)
class Job:
    """What a tree is grown by, besides the rows."""

    settings: Settings
    cuts: list[np.ndarray]
    step: float

    @property
    def bins(self) -> int:
        return max(map(len, self.cuts)) + 1

    def sums(
        self, blocks: Iterable[Block], tree: Tree, level: int, drawn: Drawn, wanted: np.ndarray
    ) -> np.ndarray:
        """Per (column, wanted node, bin): drawn rows' gradients, in steps, and number.

        ``wanted`` are nodes of the level.
        """
        columns, a, b = drawn
        cells = len(wanted) * self.bins
        share = int(self.settings.row_fraction * _PRIME)
        # Rows that ended in a leaf further up, or are in other nodes, have no cell.
        begin = np.full(len(tree.feature), -1, np.int64)
        begin[wanted] = np.arange(len(wanted)) * self.bins
        total = np.zeros((2, len(columns), cells), np.int64)
        for data, target, draw, now in blocks:
            node = begin.take(tree.leaves(data, tree.cut, level))
            keep = np.flatnonzero(((draw * np.int64(a) + b) % _PRIME < share) & (node >= 0))
            node = node.take(keep)
            gradient = np.rint((now.take(keep) - target.take(keep)) / self.step)
            for k, c in enumerate(columns):
                cell = node + data[c].take(keep)
                total[0, k] += np.bincount(cell, gradient, cells).astype(np.int64)
                total[1, k] += np.bincount(cell, minlength=cells)
        return total.reshape(2, len(columns), len(wanted), self.bins)

    def grow(self, k: int, summed: Callable[[Tree, int, Drawn, np.ndarray], np.ndarray]) -> Tree:
        """Tree ``k``, level by level; ``summed`` adds up all rows' sums for some of its nodes.

        Of two nodes with one parent only the one with fewer rows is added up: the other has
        what is left of the parent's sums, which are integers.
        """
        tree = Tree.empty(self.settings.depth)
        drawn = _drawn(self.settings, k, len(self.cuts))
        above = None
        for level in range(self.settings.depth):
            wanted = np.zeros(1, np.int64)
            if above is not None:
                wanted = _smaller_sides(tree, level, above, drawn[0])
            sums = summed(tree, level, drawn, wanted)
            if above is not None:
                sums = _both_sides(level, above, wanted, sums)
            if not _split(tree, level, sums, self.settings, drawn[0], self.cuts, self.step):
                break
            above = sums
        return tree


def _smaller_sides(tree: Tree, level: int, above: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Of each split node a level up, the side with fewer rows; ``above`` are that level's sums."""
    first, found = 2 ** (level - 1) - 1, []
    for node in range(2 ** (level - 1)):
        at = first + node
        if tree.feature[at] >= 0:
            rows = above[1, np.searchsorted(columns, tree.feature[at]), node]
            left = rows[: tree.cut[at]].sum()
            found.append(2 * at + 1 + int(rows.sum() - left < left))
    return np.array(found, np.int64)


def _both_sides(level: int, above: np.ndarray, wanted: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The sums of all nodes of a level, out of one side's of each parent and the parents'."""
    first = 2**level - 1
    whole = np.zeros((*above.shape[:2], 2**level, above.shape[3]), np.int64)
    for k, at in enumerate(wanted - first):
        whole[:, :, at] = sums[:, :, k]
        whole[:, :, at ^ 1] = above[:, :, at >> 1] - sums[:, :, k]
    return whole


def advanced(block: Block, trees: Sequence[Tree], depth: int) -> Block:
    """The block after some more trees."""
    bins, target, draw, now = block
    for tree in trees:
        now = now + tree.value.take(tree.leaves(bins, tree.cut, depth))
    return bins, target, draw, now


def _split(tree: Tree, level: int, sums, settings: Settings, columns, cuts, step: float) -> bool:
    """Split the nodes of a level where that gains, and value both sides. True if any split."""

    def value(g, n):
        return float(-settings.rate * g / (n + settings.penalty)) if n else 0.0

    def score(g, n):
        return g**2 / (n + settings.penalty)

    split = False
    for node in range(2**level):
        at = 2**level - 1 + node
        if level and tree.feature[(at - 1) // 2] < 0:
            continue
        left_g = np.cumsum(sums[0, :, node], axis=1) * step
        left_n = np.cumsum(sums[1, :, node], axis=1).astype(np.float64)
        # Every column's bins hold all rows of the node.
        whole_g, whole_n = left_g[0, -1], left_n[0, -1]
        if not level:
            tree.value[0] = value(whole_g, whole_n)
        # Left of a cut are the bins below it.
        left_g, left_n = left_g[:, :-1], left_n[:, :-1]
        right_g, right_n = whole_g - left_g, whole_n - left_n
        allowed = (left_n >= settings.least_rows) & (right_n >= settings.least_rows)
        if not allowed.any():
            continue
        gain = score(left_g, left_n) + score(right_g, right_n) - score(whole_g, whole_n)
        gain = np.where(allowed, gain, -np.inf)
        # Of equal gains, the first column and the lowest cut.
        k, below = divmod(int(np.argmax(gain)), gain.shape[1])
        if gain[k, below] <= _LEAST_GAIN:
            continue
        f = int(columns[k])
        tree.feature[at], tree.cut[at] = f, below + 1
        tree.threshold[at], tree.gain[at] = cuts[f][below], gain[k, below]
        tree.value[2 * at + 1] = value(left_g[k, below], left_n[k, below])
        tree.value[2 * at + 2] = value(right_g[k, below], right_n[k, below])
        split = True
    return split


def _advance(trees: Sequence[Tree], depth: int) -> Callable[[Block], Block]:
    return lambda block: advanced(block, trees, depth)


def _by_passes(state: RDD, job: Job, ks: range) -> list[Tree]:
    """Grow trees with a pass over all tasks' rows per level."""
    found: list[Tree] = []
    depth = job.settings.depth
    levels = 1 if state.getNumPartitions() <= FLAT_TASKS else 2
    for k in ks:

        def summed(tree, level, drawn, wanted, grown=tuple(found)):
            def part(blocks):
                # Python workers look for garbage after every task: not among the modules
                # that they have loaded, which takes longer than a pass.
                if not gc.get_freeze_count():
                    gc.freeze()
                now = (advanced(b, grown, depth) for b in blocks)
                yield job.sums(now, tree, level, drawn, wanted)

            return state.mapPartitions(part).treeReduce(np.add, levels)

        found.append(job.grow(k, summed))
    return found


def _in_one_task(state: RDD, job: Job, ks: range) -> list[Tree]:
    """Grow trees where all rows are one task's: no pass has to go through the driver."""
    depth = job.settings.depth

    def part(blocks):
        blocks = list(blocks)
        for k in ks:
            tree = job.grow(k, lambda *of: job.sums(blocks, *of))
            blocks = [advanced(b, [tree], depth) for b in blocks]
            yield tree

    return state.mapPartitions(part).collect()


def fit_trees(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    settings: Settings,
    task_rows: int = TASK_ROWS,
) -> BoostedTrees:
    """Train on rows without nulls; squared error, from the mean of the target.

    Every tree sees a drawn share of the rows and of the columns, and adds ``rate`` times
    the shrunk mean of what is left to explain. Up to ``task_rows`` rows are one task, which
    grows several trees at a time; more are dealt to all cores, and the trees are the same
    however many tasks there are. Predictions so far are kept every few trees, so a lost executor
    costs its own blocks and, in one task, those trees.
    """
    spark = train.sparkSession
    size = train.agg(
        F.count("*").alias("n"), F.avg(target).alias("mean"), F.max(F.abs(target)).alias("most")
    ).first()
    model = BoostedTrees(list(features), float(size["mean"] or 0.0), settings.depth)
    if not size["n"]:
        return model
    # No gradient is larger at first than twice the target; later ones may be a little.
    step = max(4 * float(size["most"]), 1e-300) / STEPS
    job = Job(settings, cut_points(train, features), step)
    tasks = 1
    if size["n"] > task_rows:
        # All cores take part in every pass, to its end.
        cores = max(2, spark.sparkContext.defaultParallelism)
        tasks = math.ceil(size["n"] / (cores * LARGEST_TASK * task_rows)) * cores
    raw = _blocks(train, features, target, job.cuts, tasks)
    base = model.base
    state = raw.map(lambda b: (*b[:3], np.full(len(b[1]), base)))
    state.persist(StorageLevel.MEMORY_AND_DISK)
    shared_dir(spark)  # checkpoints go there
    old = None
    grow, (each, states) = (_in_one_task, IN_TASK) if tasks == 1 else (_by_passes, BY_PASSES)
    for first in range(0, settings.trees, each):
        trees = grow(state, job, range(first, min(first + each, settings.trees)))
        model.trees += trees
        if old is not None:
            # The newer state has been read in full.
            old.unpersist()
        old, state = state, state.map(_advance(trees, settings.depth))
        state.persist(StorageLevel.MEMORY_AND_DISK)
        if (first // each + 1) % states == 0:
            state.checkpoint()
    for left in (old, state):
        left.unpersist()
    return model
