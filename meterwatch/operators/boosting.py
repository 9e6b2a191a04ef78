"""Boosted trees on histograms of one binned table, whatever its size.

Numbers become bins once, at cut points of a bounded sample, categories become their code, rows
that are equal in all bins become one with its rows and its labels counted, as they have the same
score, and the binned table is written down, many rows to a record, so that the jobs of a tree
read a few arrays. Nodes of a tree with many rows are split level by level, one
job each: every task sums gradients, curvatures and rows of its partition per (node, bin) in
numpy, partial histograms are summed per node, and the driver chooses the splits from sums whose
size depends on bins and nodes, never on rows. Of two sister nodes only the smaller one is
summed; the other is the parent less the sister. Nodes whose rows fit in a task are sent to
tasks of their own, which grow what is below them by the same rules; that is one more job for
all of them. So a tree takes as many jobs as it has levels of large nodes, and one. Gradients
are whole multiples of 2**-24, so sums are exact, and neither partitions, row order nor where a
node is grown change a tree.

With ``leaves`` a tree grows leaf by leaf, best gain first. A level speculates on those nodes
that best-first growth can still reach: growing more nodes never moves a known node forward in
that order, so a node beyond the last place is out for good, and the tree that remains is the
one that splitting a single leaf at a time would give.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from meterwatch.session import persist_table

#: Rows that cut points are taken from, rows of the binned table in a task, and rows of a node that one task grows on.
CUT_ROWS, TASK_ROWS, LOCAL_ROWS = 100_000, 250_000, 100_000
#: Rows in a record of the binned table, and partial histograms that the driver adds up without a shuffle.
PACK_ROWS, FEW_PARTS = 32_768, 64
#: Trees after which the scores of the rows are written anew.
FLUSH = 10
#: Gradients are whole multiples of one part in this.
GRAIN = float(1 << 24)
#: Gains below are rounding.
LEAST_GAIN = 1e-9
MISSING = "__missing"


@dataclass(frozen=True)
class Growth:
    """How trees grow: ``leaves`` for best-first growth, ``depth`` for a bound on levels, or both."""
    trees: int = 100
    rate: float = 0.1
    leaves: int | None = None
    depth: int | None = None
    min_rows: int = 1
    min_curvature: float = 1e-3
    shrink: float = 0.0
    bins: int = 255

    def __post_init__(self) -> None:
        if self.leaves is None and self.depth is None:
            raise ValueError("leaves or depth must bound a tree")


@dataclass
class Bins:
    """Cut points of the numeric columns and values of the category columns."""
    numeric: list[str]
    cuts: list[list[float]]
    categories: list[str]
    values: list[list[str]]

    @property
    def sizes(self) -> list[int]:
        return [len(c) + 1 for c in self.cuts] + [len(v) + 1 for v in self.values]

    @property
    def offsets(self) -> np.ndarray:
        return np.r_[0, np.cumsum(self.sizes)].astype(np.int64)

    def matrix(self, batch: pa.RecordBatch) -> np.ndarray:
        """(rows, features) of bins; missing numbers count as 0, an unseen category has a bin that no split names."""
        columns = []
        for name, cuts in zip(self.numeric, self.cuts):
            x = pc.fill_null(batch.column(name).cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
            columns.append(np.searchsorted(np.array(cuts), np.where(np.isnan(x), 0.0, x), side="left"))
        for name, values in zip(self.categories, self.values):
            text = pc.fill_null(batch.column(name).cast(pa.string()), MISSING)
            code = pc.index_in(text, value_set=pa.array(values, pa.string()))
            columns.append(pc.fill_null(code, len(values)).to_numpy(zero_copy_only=False))
        return np.stack(columns, axis=1).astype(np.int32) if columns else np.zeros((batch.num_rows, 0), np.int32)


@dataclass
class Tree:
    """Nodes by number, the root is 0; ``feature`` -1 marks a leaf, ``value`` is what a leaf adds to the score."""
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.cut[node] = feature, cut
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for v in values:
            for column, x in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, v)):
                column.append(x)
        return self.left[node], self.right[node]

    def nodes(self, x: np.ndarray, numeric: int) -> np.ndarray:
        """The leaf of every row; up to ``numeric`` features are ordered, the others are codes."""
        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x)) if feature[0] >= 0 else np.zeros(0, np.int64)
        while len(rows):
            here = at[rows]
            f = feature[here]
            b = x[rows, f]
            high = np.where(f < numeric, b > cut[here], b == cut[here])
            at[rows] = np.where(high, right[here], left[here])
            rows = rows[feature[at[rows]] >= 0]
        return at


@dataclass
class BoostedModel:
    """Fitted trees with the bins that rows meet them in."""
    bins: Bins
    base: float
    trees: list[Tree]

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += np.array(t.value)[t.nodes(x, len(self.bins.numeric))]
        return out

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Probability of label 1 next to the columns of ``df``; one pass, no shuffle."""
        model = df.sparkSession.sparkContext.broadcast(self)  # trees x leaves, whatever the rows

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                p = 1 / (1 + np.exp(-model.value.raw(model.value.bins.matrix(b))))
                yield b.append_column(out, pa.array(p))

        return df.mapInArrow(run, StructType([*df.schema.fields, StructField(out, DoubleType())]))

    def save(self, spark: SparkSession, path: str) -> None:
        text = json.dumps({"bins": vars(self.bins), "base": self.base, "trees": [vars(t) for t in self.trees]})
        spark.createDataFrame([(text,)], "model string").write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedModel:
        held = json.loads(spark.read.parquet(path).first()["model"])
        return BoostedModel(Bins(**held["bins"]), held["base"], [Tree(**t) for t in held["trees"]])


# --- the binned table -------------------------------------------------------

def find_bins(rows: DataFrame, count: int, numeric: Sequence[str], categories: Sequence[str], id_cols: Sequence[str], bins: int) -> Bins:
    """Cut points from the first ``CUT_ROWS`` rows in order of a hash, values of all rows.

    Columns with few different values are cut between them; the cuts of others are
    quantiles. Values of a category are as many as there are categories.
    """
    sample = rows.select(*numeric, F.xxhash64(*id_cols).alias("__h"))
    if count > CUT_ROWS:
        rate = min(1.0, 1.2 * CUT_ROWS / count)
        sample = sample.filter((F.col("__h").cast("double") + 2.0 ** 63) / 2.0 ** 64 < rate).orderBy("__h", *numeric).limit(CUT_ROWS)
    cuts = []
    for column in sample.select(*[F.col(c).cast("double") for c in numeric]).toArrow().columns:  # ``CUT_ROWS`` rows at most
        x = np.sort(np.nan_to_num(column.to_numpy(), nan=0.0))
        known = np.unique(x)
        if len(known) > bins:
            known = np.unique(x[np.ceil(len(x) * np.arange(1, bins + 1) / bins).astype(int) - 1])
        cuts.append(known[:-1].tolist())
    values = [sorted(r[0] for r in rows.select(F.coalesce(F.col(c).cast("string"), F.lit(MISSING))).distinct().collect()) for c in categories]
    return Bins(list(numeric), cuts, list(categories), values)


def narrowest(bins: Bins) -> type:
    """The type that bins travel in."""
    return np.uint8 if max(bins.sizes, default=0) <= 1 << 8 else np.uint16 if max(bins.sizes) <= 1 << 16 else np.int32


def by_slot(slot: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each slot with the rows that are in it."""
    order = np.argsort(slot, kind="stable")
    order = order[np.searchsorted(slot[order], 0):]
    found, starts = np.unique(slot[order], return_index=True)
    yield from zip(found.tolist(), np.split(order, starts[1:]))


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches put together to tables of about ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(h.num_rows for h in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _cells(rows: DataFrame, bins: Bins, label: str) -> DataFrame:
    """ones, rows, b0, b1, ...: one row for all that are equal in every bin; written down once."""
    names = [f"b{j}" for j in range(len(bins.sizes))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(label).cast(pa.int64()), *[pa.array(c) for c in bins.matrix(b).T]], names=["label", *names])

    table = rows.mapInArrow(run, "label long" + "".join(f", {c} int" for c in names))
    return persist_table(table.groupBy(*names).agg(F.sum("label").alias("ones"), F.count(F.lit(1)).alias("rows")))


def _binned(cells: DataFrame, bins: Bins, base: float, tasks: int) -> DataFrame:
    """ones, rows, score, x: arrays over ``PACK_ROWS`` cells as bytes; written down once."""
    names, kind = [f"b{j}" for j in range(len(bins.sizes))], narrowest(bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, PACK_ROWS):
            x = np.stack([b.column(c).to_numpy() for c in names], axis=1).astype(kind)
            arrays = (b.column("ones").to_numpy(), b.column("rows").to_numpy(), np.full(len(x), base), x)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in arrays], names=["ones", "rows", "score", "x"])

    return persist_table(cells.repartition(tasks).mapInArrow(run, "ones binary, rows binary, score binary, x binary")).persist()  # read by every job; a lost part is read again


def _arrays(b: pa.RecordBatch, bins: Bins) -> Iterator[tuple[np.ndarray, ...]]:
    """ones, rows, score, x of each record."""
    kinds = {"ones": np.int64, "rows": np.int64, "score": np.float64, "x": narrowest(bins)}
    for j in range(b.num_rows):
        ones, rows, score, x = (np.frombuffer(b.column(c)[j].as_buffer(), kind) for c, kind in kinds.items())
        yield ones, rows, score, x.reshape(len(ones), -1)


def _advance(x: np.ndarray, score: np.ndarray, trees: Sequence[Tree], numeric: int) -> np.ndarray:
    for t in trees:
        score = score + np.array(t.value)[t.nodes(x, numeric)]
    return score


def _flushed(binned: DataFrame, trees: Sequence[Tree], bins: Bins) -> DataFrame:
    """The table with the scores after ``trees``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [_advance(x, score, trees, len(bins.numeric)).tobytes() for _, _, score, x in _arrays(b, bins)]
            yield b.set_column(2, "score", pa.array(scores, pa.binary()))

    out = persist_table(binned.mapInArrow(run, binned.schema)).persist()
    binned.unpersist()
    return out


def _state(b: pa.RecordBatch, bins: Bins, tree: Tree, done: Sequence[Tree], slot_of: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Of the cells in wanted nodes: slot, bins, gradient and curvature (whole numbers, of all their rows), rows."""
    numeric = len(bins.numeric)
    for ones, rows, score, x in _arrays(b, bins):
        slot = slot_of[tree.nodes(x, numeric)]
        keep = slot >= 0
        x, ones, rows = x[keep], ones[keep], rows[keep]
        p = 1 / (1 + np.exp(-_advance(x, score[keep], done, numeric)))
        yield (slot[keep], x, ones * np.rint((p - 1) * GRAIN) + (rows - ones) * np.rint(p * GRAIN), rows * np.rint(p * (1 - p) * GRAIN), rows)


def _sums(slot: np.ndarray, x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, slots: int, offsets: np.ndarray) -> np.ndarray:
    """(slots, bins, 3) of gradient, curvature and rows; exact as long as a task has below 2**29 rows."""
    width = int(offsets[-1])
    total = np.zeros((3, slots * width))
    for j in range(x.shape[1]):
        place = slot * width + offsets[j] + x[:, j]
        for k, weight in enumerate((g, h, rows)):
            total[k] += np.bincount(place, weight, total.shape[1])
    return total.reshape(3, slots, width).transpose(1, 2, 0).astype(np.int64)


def _slots(tree: Tree, wanted: Sequence[int]) -> np.ndarray:
    slot_of = np.full(len(tree.feature), -1, np.int64)
    slot_of[list(wanted)] = np.arange(len(wanted))
    return slot_of


def _histograms(binned: DataFrame, done: Sequence[Tree], bins: Bins, tasks: int, tree: Tree, wanted: Sequence[int]) -> np.ndarray:
    """(nodes, bins, 3) for the nodes of ``wanted``, in one job."""
    slot_of, offsets = _slots(tree, wanted), bins.offsets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(wanted), int(offsets[-1]), 3), np.int64)
        for b in batches:
            for state in _state(b, bins, tree, done, slot_of):
                total += _sums(*state, len(wanted), offsets)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(wanted)), pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())],
                                         names=["slot", "sums"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, s in zip(b.column("slot").to_pylist(), b.column("sums").to_pylist()):
                held[k] = held.get(k, 0) + np.frombuffer(s, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([s.tobytes() for s in held.values()], pa.binary())],
                                         names=["slot", "sums"])

    parts = binned.mapInArrow(run, "slot int, sums binary")
    if tasks * len(wanted) > FEW_PARTS:
        parts = parts.repartition(min(tasks, len(wanted)), "slot").mapInArrow(join, "slot int, sums binary")
    out = np.zeros((len(wanted), int(offsets[-1]), 3), np.int64)
    for r in parts.collect():  # nodes x bins numbers
        out[r["slot"]] += np.frombuffer(r["sums"], np.int64).reshape(out.shape[1:])
    return out


# --- growing -----------------------------------------------------------------

@dataclass
class Split:
    gain: float
    feature: int
    cut: int
    left: list[int]  # gradient, curvature, rows
    right: list[int]


def best_splits(sums: np.ndarray, bins: Bins, grow: Growth) -> list[Split | None]:
    """For each node the split with the highest gain: the first feature and bin on ties, None without a gain.

    A number is cut at a bin, a category is one value against the others.
    """
    offsets, n = bins.offsets, len(sums)
    total = sums[:, offsets[0]:offsets[1]].sum(1)
    right = np.empty_like(sums)
    for f in range(len(bins.sizes)):
        own = sums[:, offsets[f]:offsets[f + 1]]
        right[:, offsets[f]:offsets[f + 1]] = own if f >= len(bins.numeric) else total[:, None] - np.cumsum(own, axis=1)
    left = total[:, None] - right

    def part(s: np.ndarray) -> np.ndarray:
        return s[..., 0].astype(float) ** 2 / GRAIN / np.maximum(s[..., 1] + grow.shrink * GRAIN, 1.0)

    fits = (np.minimum(left[..., 2], right[..., 2]) >= max(1, grow.min_rows)) & (
        np.minimum(left[..., 1], right[..., 1]) >= grow.min_curvature * GRAIN)
    gain = np.where(fits, part(left) + part(right) - part(total)[:, None], -np.inf)
    at = gain.argmax(1)
    best = gain[np.arange(n), at]
    feature = np.searchsorted(offsets, at, side="right") - 1
    return [Split(float(best[k]), int(feature[k]), int(at[k] - offsets[feature[k]]), left[k, at[k]].tolist(), right[k, at[k]].tolist())
            if best[k] > LEAST_GAIN else None for k in range(n)]


def _leaf(s: Sequence[int], grow: Growth) -> float:
    return float(-grow.rate * s[0] / max(s[1] + grow.shrink * GRAIN, 1.0))


def _chosen(splits: dict[int, Split | None], tree: Tree, most: int) -> list[int]:
    """Nodes that best-first growth splits, in its order, among the nodes that are known.

    Of equal gains the higher node, then the one further left goes first, whatever its number.
    """
    heap, order = [], []

    def offer(node: int, path: str) -> None:
        s = splits.get(node)
        if s is not None:
            heapq.heappush(heap, (-s.gain, len(path), path, node))

    offer(0, "")
    while heap and len(order) < most:
        _, _, path, node = heapq.heappop(heap)
        order.append(node)
        if tree.feature[node] >= 0:
            offer(tree.left[node], path + "0")
            offer(tree.right[node], path + "1")
    return order


@dataclass
class _Grown:
    """A tree with more nodes than it will keep, their splits, and nodes (with their depth) left to others."""
    tree: Tree
    splits: dict[int, Split | None]
    small: list[tuple[int, int]]


def _grow(histograms: Callable[[Tree, list[int]], np.ndarray], bins: Bins, grow: Growth, depth: int | None, local: int) -> _Grown:
    """Levels below a root as long as nodes have more than ``local`` rows."""
    most, least = (grow.leaves or 2 ** 31) - 1, 2 * max(1, grow.min_rows)
    tree = Tree()
    sums = {0: histograms(tree, [0])[0]}
    tree.value[0] = _leaf(sums[0][:bins.offsets[1]].sum(0), grow)
    splits: dict[int, Split | None] = {0: best_splits(sums[0][None], bins, grow)[0]}
    level, frontier, small = 0, [0], []
    while frontier and (depth is None or level < depth):
        reached = set(_chosen(splits, tree, most))
        level += 1
        wanted: dict[int, tuple[int, int, bool, bool]] = {}
        for node in [n for n in frontier if n in reached]:
            s = splits[node]
            low, high = tree.split(node, s.feature, s.cut, (_leaf(s.left, grow), _leaf(s.right, grow)))
            opens = []
            for child, part in ((low, s.left), (high, s.right)):
                opened = part[2] >= least and (depth is None or level < depth)
                if opened and part[2] <= local:
                    small.append((child, level))
                opens.append(opened and part[2] > local)
            if any(opens):
                if s.left[2] <= s.right[2]:
                    wanted[low] = (node, high, opens[0], opens[1])
                else:
                    wanted[high] = (node, low, opens[1], opens[0])
        frontier = []
        if not wanted:
            break
        found = histograms(tree, list(wanted))
        fresh: dict[int, np.ndarray] = {}
        for own, (first, (parent, second, one, two)) in zip(found, wanted.items()):
            fresh |= ({first: own} if one else {}) | ({second: sums[parent] - own} if two else {})
        splits |= dict(zip(fresh, best_splits(np.stack(list(fresh.values())), bins, grow)))
        sums, frontier = fresh, list(fresh)
    return _Grown(tree, splits, small)


def _finish(binned: DataFrame, done: Sequence[Tree], bins: Bins, grow: Growth, tasks: int, tree: Tree,
            small: list[tuple[int, int]]) -> dict[int, _Grown]:
    """What grows below nodes of at most ``LOCAL_ROWS`` rows: a task each, one job for all."""
    slot_of, numeric, kind = _slots(tree, [n for n, _ in small]), len(bins.numeric), narrowest(bins)

    def below(slot: int, x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray) -> str:
        depth = None if grow.depth is None else grow.depth - small[slot][1]

        def histograms(t: Tree, wanted: list[int]) -> np.ndarray:
            at = _slots(t, wanted)[t.nodes(x, numeric)]
            keep = at >= 0
            return _sums(at[keep], x[keep], g[keep], h[keep], rows[keep], len(wanted), bins.offsets)

        grown = _grow(histograms, bins, grow, depth, 0)
        return json.dumps({"tree": vars(grown.tree), "splits": {n: s and vars(s) for n, s in grown.splits.items()}})

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for b in batches:
            yield from _state(b, bins, tree, done, slot_of)

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(states(batches))
        if parts:
            slot, *rest = (np.concatenate(c) for c in zip(*parts))
            found = [(k, below(k, *(c[rows] for c in rest))) for k, rows in by_slot(slot)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int32()), pa.array([t for _, t in found], pa.string())],
                                             names=["slot", "grown"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, *rest in states(batches):
            groups = list(by_slot(slot))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in groups], pa.int32()), *[pa.array([c[rows].tobytes() for _, rows in groups], pa.binary()) for c in rest]],
                names=["slot", "x", "g", "h", "rows"])

    def take(table: pa.Table) -> pa.Table:
        k = table.column("slot")[0].as_py()
        x, g, h, rows = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("x", kind), ("g", float), ("h", float), ("rows", np.int64)))
        return pa.table([pa.array([k], pa.int32()), pa.array([below(k, x.reshape(len(g), -1), g, h, rows)])], names=["slot", "grown"])

    if tasks == 1:  # all rows are in one partition as they are
        found = binned.mapInArrow(here, "slot int, grown string")
    else:
        sent = binned.mapInArrow(send, "slot int, x binary, g binary, h binary, rows binary")
        found = sent.repartition(min(tasks, len(small)), "slot").groupBy("slot").applyInArrow(take, "slot int, grown string")
    out = {}
    for r in found.collect():  # nodes x leaves
        held = json.loads(r["grown"])
        out[small[r["slot"]][0]] = _Grown(Tree(**held["tree"]), {int(n): s and Split(**s) for n, s in held["splits"].items()}, [])
    return out


def grow_tree(binned: DataFrame, done: Sequence[Tree], bins: Bins, grow: Growth, rows: int, tasks: int) -> Tree:
    """The next tree: a job per level of large nodes, and one for all small ones."""
    if rows > LOCAL_ROWS:
        grown = _grow(lambda tree, wanted: _histograms(binned, done, bins, tasks, tree, wanted), bins, grow, grow.depth, LOCAL_ROWS)
    else:
        grown = _Grown(Tree(), {}, [(0, 0)])
    tree, splits = grown.tree, grown.splits
    if grown.small:
        for node, part in _finish(binned, done, bins, grow, tasks, tree, grown.small).items():
            names = {0: node}
            if node == 0:
                tree.value[0] = part.tree.value[0]
            for own in range(len(part.tree.feature)):  # a parent has a smaller number than its children
                splits[names[own]] = part.splits.get(own)
                if part.tree.feature[own] >= 0:
                    low, high = part.tree.left[own], part.tree.right[own]
                    names[low], names[high] = tree.split(names[own], part.tree.feature[own], part.tree.cut[own],
                                                         (part.tree.value[low], part.tree.value[high]))
    # what best-first growth takes of the nodes that were tried
    final = Tree(value=[tree.value[0]])
    names = {0: 0}
    for node in _chosen(splits, tree, (grow.leaves or 2 ** 31) - 1):
        if tree.feature[node] >= 0:
            s = splits[node]
            names[tree.left[node]], names[tree.right[node]] = final.split(
                names[node], s.feature, s.cut, (tree.value[tree.left[node]], tree.value[tree.right[node]]))
    return final


def fit_boosted(df: DataFrame, grow: Growth, numeric: Sequence[str], categories: Sequence[str] = (), label: str = "label",
                id_cols: Sequence[str] = ()) -> BoostedModel:
    """Boosted trees for a label of 0 or 1 (logistic loss, Newton steps).

    Rows without a label are left out; missing numbers count as 0, missing categories are a
    category; NaN counts as missing. ``id_cols`` name what the sample for the cut points is hashed from; without
    them all columns are taken. With one label only, or no rows, the model is a constant.
    Runs jobs when called: three tables are written (rows, cells, packed cells), the last anew after
    every ten trees, and every job of a tree reads it once.
    """
    columns = list(dict.fromkeys([*numeric, *categories, label, *id_cols]))
    rows = persist_table(df.select(*columns).filter(F.col(label).isNotNull()).fillna(0.0, subset=list(numeric)))
    seen = rows.agg(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("ones")).first()
    n, ones = seen["n"], seen["ones"]
    if not 0 < ones < n:
        base = 0.0 if n == 0 else 30.0 if ones else -30.0
        return BoostedModel(Bins(list(numeric), [[] for _ in numeric], list(categories), [[] for _ in categories]), base, [])
    base = float(np.log(ones / (n - ones)))
    bins = find_bins(rows, n, numeric, categories, list(id_cols) or columns, grow.bins)
    cells = _cells(rows, bins, label)
    n = cells.count()
    tasks = max(1, -(-n // TASK_ROWS))
    if n > LOCAL_ROWS:
        tasks = max(tasks, df.sparkSession.sparkContext.defaultParallelism)
    binned = _binned(cells, bins, base, tasks)
    trees: list[Tree] = []
    pending: list[Tree] = []
    for k in range(grow.trees):
        tree = grow_tree(binned, pending, bins, grow, n, tasks)
        trees.append(tree)
        pending.append(tree)
        if len(tree.feature) == 1 and abs(tree.value[0]) < 1e-12:
            break  # nothing is left to learn, further trees would be the same
        if len(pending) == FLUSH and k + 1 < grow.trees:
            binned, pending = _flushed(binned, pending, bins), []
    binned.unpersist()
    return BoostedModel(bins, base, trees)
