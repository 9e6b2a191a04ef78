"""A forest of full-depth trees over the binned table of the boosting module.

Every tree sees each row with a Poisson weight that is a digest of seed, tree and id, and every
node tries a few features that a digest of its path names, so a forest follows from its rows
alone. Nodes with many rows are split level by level for all trees at once: tasks sum weights and
weighted labels per (node, bin), the driver picks the splits. A node whose rows fit in a task is
sent to a task of its own, which grows what is below to the end; that is one job for the nodes
of all trees. Depth has no bound unless one is asked for.

What those tasks grow stays a table, one row per node they were given: the driver and every
worker know the tops of the trees only, whatever the number of rows. To score, rows go to the
parts that they reach, and their values come back by blocks of rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from meterwatch.operators.boosting import LOCAL_ROWS, TASK_ROWS, Bins, Tree, by_slot, find_bins, narrowest, pieces
from meterwatch.session import persist_table, spread

#: Nodes whose sums a job holds at a time, nodes a task splits side by side, and nodes that a part of a tree may have, as a task holds a part.
JOB_NODES, CHUNK_NODES, MOST_NODES = 2_048, 256, 40_000_000
#: Rows whose scores are put together at a time, and rows that go through a copy of a part.
BLOCK_ROWS, VISIT_ROWS = 32_768, 1_000_000
#: Upper ends of the shares of the weights 0, 1, 2, ... under a Poisson law with mean 1.
_WEIGHTS = np.exp(-1) * np.cumsum([1, 1, 1 / 2, 1 / 6, 1 / 24, 1 / 120, 1 / 720, 1 / 5040])
#: Numbers of ids, draws and paths are below this prime, so that any engine can compute with them in 64 bits.
PRIME = 2 ** 31 - 1
#: (multiplier, summand) that lead from a node's path to those of its two children.
STEPS = ((48_271, 1), (69_621, 2))


def scrambles(seed: int, what: str, n: int) -> list[tuple[int, int]]:
    """``n`` pairs (multiplier, summand) below ``PRIME`` from the digest of seed, purpose and number."""
    out = []
    for k in range(n):
        digest = hashlib.md5(f"{seed}:{what}:{k}".encode()).digest()
        out.append((1 + int.from_bytes(digest[:4], "big") % (PRIME - 1), int.from_bytes(digest[4:8], "big") % PRIME))
    return out


def id_number(*names: str) -> Column:
    """A number below ``PRIME`` from the digest of the columns as text."""
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in names])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % PRIME


@lru_cache(maxsize=1_024)
def _bag(seed: int, tree: int) -> tuple[int, int]:
    return scrambles(seed, f"bag{tree}", 1)[0]


def bag_weights(number: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row counts in a tree."""
    m, c = _bag(seed, tree)
    return np.searchsorted(_WEIGHTS, (number * m + c) % PRIME / PRIME, side="right")


def root_paths(seed: int, trees: int) -> list[int]:
    return [c for _, c in scrambles(seed, "root", trees)]


def child_paths(paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The paths of the two nodes below those given."""
    return tuple((paths * m + c) % PRIME for m, c in STEPS)


def tried_features(paths: np.ndarray, features: int, tried: int) -> np.ndarray:
    """(nodes, features): which features a node tries first."""
    pairs = np.array(scrambles(0, "feature", features), np.int64).reshape(-1, 2)
    keys = (paths[:, None] * pairs[None, :, 0] + pairs[None, :, 1]) % PRIME
    return keys.argsort(axis=1, kind="stable").argsort(axis=1) < tried


@dataclass(frozen=True)
class Bagging:
    trees: int = 100
    depth: int | None = None
    min_rows: int = 1
    bins: int = 64
    tried: int | None = None
    seed: int = 42


def best_cuts(sums: np.ndarray, paths: np.ndarray, bins: Bins, bag: Bagging) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut, sums of the upper part) of each node; feature -1 where nothing separates labels.

    ``sums`` is (nodes, bins, 2): weighted labels, weights. The best cut by Gini impurity among
    the features tried, else among all; ties go to the first feature and bin.
    """
    offsets, n, features = bins.offsets, len(sums), len(bins.sizes)
    total = sums[:, offsets[0]:offsets[1]].sum(1)
    high = np.empty_like(sums)
    for f in range(features):
        own = sums[:, offsets[f]:offsets[f + 1]]
        high[:, offsets[f]:offsets[f + 1]] = own if f >= len(bins.numeric) else total[:, None] - np.cumsum(own, axis=1)
    low = total[:, None] - high
    part = lambda s: s[..., 0].astype(float) ** 2 / np.maximum(s[..., 1], 1)
    fits = np.minimum(low[..., 1], high[..., 1]) >= bag.min_rows
    gain = np.where(fits, part(low) + part(high) - part(total)[:, None], -np.inf)
    tried = tried_features(paths, features, bag.tried or max(1, int(features ** 0.5)))
    first = np.where(np.repeat(tried, np.diff(offsets), axis=1), gain, -np.inf)
    at, rows = first.argmax(1), np.arange(n)
    none = ~(first[rows, at] > 1e-9)
    at[none] = gain[none].argmax(1)
    found = gain[rows, at] > 1e-9
    feature = np.where(found, np.searchsorted(offsets, at, side="right") - 1, -1)
    return feature, at - offsets[np.maximum(feature, 0)], high[rows, at]


def _bin_sums(slot: np.ndarray, x: np.ndarray, wy: np.ndarray, w: np.ndarray, slots: int, offsets: np.ndarray) -> np.ndarray:
    width = int(offsets[-1])
    total = np.zeros((2, slots * width))
    for j in range(x.shape[1]):
        place = slot * width + offsets[j] + x[:, j]
        total[0] += np.bincount(place, wy, total.shape[1])
        total[1] += np.bincount(place, w, total.shape[1])
    return total.reshape(2, slots, width).transpose(1, 2, 0).astype(np.int64)


def grow_to_the_end(x: np.ndarray, wy: np.ndarray, w: np.ndarray, path: int, depth: int | None, bins: Bins, bag: Bagging) -> Tree:
    """The tree below one node, all its rows at hand, level by level."""
    tree = Tree(value=[float(wy.sum() / max(1, w.sum()))])
    node = np.zeros(len(x), np.int64)  # place of each row's node in ``open_``
    open_, paths = [0], np.array([path], np.int64)
    level = 0
    while open_ and (depth is None or level < depth):
        level += 1
        held = np.stack([np.bincount(node, wy, len(open_)), np.bincount(node, w, len(open_))], axis=1)
        mixed = (held[:, 0] > 0) & (held[:, 0] < held[:, 1]) & (held[:, 1] >= 2 * bag.min_rows)
        feature, cut = np.full(len(open_), -1), np.zeros(len(open_), np.int64)
        upper = np.zeros((len(open_), 2), np.int64)
        wanted = np.flatnonzero(mixed)
        slot_of = np.full(len(open_), -1)
        for start in range(0, len(wanted), CHUNK_NODES):
            some = wanted[start:start + CHUNK_NODES]
            slot_of[:] = -1
            slot_of[some] = np.arange(len(some))
            keep = slot_of[node] >= 0
            sums = _bin_sums(slot_of[node[keep]], x[keep], wy[keep], w[keep], len(some), bins.offsets)
            feature[some], cut[some], upper[some] = best_cuts(sums, paths[some], bins, bag)
        splits = np.flatnonzero(feature >= 0)
        below, fresh = np.full((len(open_), 2), -1), []
        for k in splits.tolist():
            h, a = upper[k], held[k] - upper[k]
            tree.split(open_[k], int(feature[k]), int(cut[k]), (float(a[0] / a[1]), float(h[0] / h[1])))
            below[k] = len(fresh), len(fresh) + 1
            fresh += [tree.left[open_[k]], tree.right[open_[k]]]
        keep = feature[node] >= 0
        x, wy, w, node = x[keep], wy[keep], w[keep], node[keep]
        b = x[np.arange(len(x)), feature[node]]
        high = np.where(feature[node] < len(bins.numeric), b > cut[node], b == cut[node])
        node = below[node, high.astype(int)]
        one, two = child_paths(paths[splits])
        open_, paths = fresh, np.stack([one, two], axis=1).ravel()
    return tree


# --- the forest on a cluster -------------------------------------------------

#: A tree, or what is below a node of one, as columns of a table.
NODES = "feature array<int>, cut array<int>, left array<int>, right array<int>, value array<double>"


def _lists(tree: Tree) -> list[pa.Array]:
    return [pa.array([np.asarray(getattr(tree, c), float if c == "value" else np.int32)], pa.list_(pa.float64() if c == "value" else pa.int32()))
            for c in ("feature", "cut", "left", "right", "value")]


def _tree_at(table: pa.Table | pa.RecordBatch, row: int) -> Tree:
    return Tree(*(table.column(c)[row].values.to_numpy() for c in ("feature", "cut", "left", "right", "value")))


def _slots(tops: Sequence[Tree], places: Sequence[tuple[int, int]]) -> dict[int, np.ndarray]:
    """By tree: the slot of each of its leaves that has a part, -1 for the others."""
    named: dict[int, np.ndarray] = {}
    for slot, (t, node) in enumerate(places):
        named.setdefault(t, np.full(len(tops[t].feature), -1))[node] = slot
    return named


@dataclass
class ForestModel:
    """Trees of full depth and the bins that rows meet them in; the score is the mean of the leaves' shares.

    ``tops`` are the trees as far as their nodes have many rows; ``parts`` is a table (slot and
    ``NODES``) of what is below the (tree, leaf) of ``places``, in order of the slots. It is
    never brought to the driver or sent to all workers.
    """
    bins: Bins
    tops: list[Tree]
    places: list[tuple[int, int]] = field(default_factory=list)
    parts: DataFrame | None = None

    @property
    def trees(self) -> list[Tree]:
        """The whole trees in the driver, for a small forest."""
        trees = list(self.tops)
        if self.places:
            size = self.parts.agg(F.sum(F.size("feature"))).first()[0]
            if size > MOST_NODES:
                raise ValueError(f"the forest has {size} nodes, too many for the driver")
            for b in self.parts.orderBy("slot").toArrow().to_batches():  # MOST_NODES nodes at most
                for j in range(b.num_rows):
                    t, node = self.places[b.column("slot")[j].as_py()]
                    trees[t] = _graft(trees[t], node, _tree_at(b, j))
        return trees

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Share of label 1 next to the columns of ``df``.

        Writes ``df`` down once when called, with a number for each row, and counts the rows that
        reach each part; parts that many rows reach are copied for groups of blocks.
        """
        bins, tops, numeric, trees = self.bins, self.tops, len(self.bins.numeric), len(self.tops)
        final = StructType([*df.schema.fields, StructField(out, DoubleType())])
        named = _slots(tops, self.places)
        narrow = narrowest(bins)

        def at_tops(x: np.ndarray, whole: Callable[[int], Iterator[tuple[np.ndarray, np.ndarray]]]) -> np.ndarray:
            """Mean over the trees, always in their order; ``whole`` has (rows, values) that parts gave."""
            total = np.zeros(len(x))
            for t, top in enumerate(tops):
                value = np.asarray(top.value)[top.nodes(x, numeric)]
                for rows, found in whole(t):
                    value[rows] = found
                total += value
            return total / max(1, trees)

        def score_tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.append_column(out, pa.array(at_tops(bins.matrix(b), lambda t: iter(()))))

        if not self.places:
            return df.mapInArrow(score_tops, final)

        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first, n = TaskContext.get().partitionId() << 32, 0
            for b in batches:
                at = np.arange(n, n + b.num_rows)
                n += b.num_rows
                yield b.append_column("__block", pa.array(first + at // BLOCK_ROWS)).append_column("__at", pa.array((at % BLOCK_ROWS).astype(np.int32)))

        numbered = "__block long, __at int"
        placed = persist_table(spread(df).mapInArrow(number, StructType([*df.schema.fields, *StructType.fromDDL(numbered).fields])))
        seen = placed.select("__block", "__at", *bins.numeric, *bins.categories)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(places), np.int64)
            for b in batches:
                x = bins.matrix(b)
                for t, slot_of in named.items():
                    slot = slot_of[tops[t].nodes(x, numeric)]
                    total += np.bincount(slot[slot >= 0], minlength=len(places))
            reached = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(reached.astype(np.int32)), pa.array(total[reached])], names=["slot", "rows"])

        places = self.places
        reached = {r["slot"]: r["rows"] for r in seen.mapInArrow(count, "slot int, rows long").groupBy("slot").agg(F.sum("rows").alias("rows")).collect()}  # a row per part
        copies = np.ones(len(places), np.int64)
        for slot, rows in reached.items():
            copies[slot] = -(-rows // VISIT_ROWS)

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in pieces(batches, BLOCK_ROWS):
                x = bins.matrix(b).astype(narrow)
                block, at = (b.column(c).to_numpy() for c in ("__block", "__at"))
                for part in np.unique(block).tolist():
                    here = np.flatnonzero(block == part)
                    for t, slot_of in named.items():
                        groups = list(by_slot(slot_of[tops[t].nodes(x[here], numeric)]))
                        if groups:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([s for s, _ in groups], pa.int32()), pa.array([part % int(copies[s]) for s, _ in groups], pa.int32()),
                                 pa.array([part] * len(groups), pa.int64()), pa.array([at[here[r]].tobytes() for _, r in groups], pa.binary()),
                                 pa.array([x[here[r]].tobytes() for _, r in groups], pa.binary())], names=["slot", "copy", "block", "rows", "x"])

        def visit(sent: pa.Table, part: pa.Table) -> pa.Table:
            if sent.num_rows == 0:
                return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.binary(), pa.binary())], names=["block", "tree", "rows", "found"])
            tree = _tree_at(part, 0)
            value, found = np.asarray(tree.value), []
            for raw in sent.column("x"):
                x = np.frombuffer(raw.as_buffer(), narrow).reshape(-1, len(bins.sizes))
                found.append(value[tree.nodes(x, numeric)].tobytes())
            t = places[part.column("slot")[0].as_py()][0]
            return pa.table([sent.column("block"), pa.array([t] * sent.num_rows, pa.int32()), sent.column("rows"), pa.array(found, pa.binary())],
                            names=["block", "tree", "rows", "found"])

        def gather(rows: pa.Table, given: pa.Table) -> pa.Table:
            rows = rows.sort_by("__at").combine_chunks()
            place = np.full(BLOCK_ROWS, -1)
            place[rows.column("__at").to_numpy()] = np.arange(rows.num_rows)
            by_tree: dict[int, list[int]] = {}
            for j, t in enumerate(given.column("tree").to_pylist()):
                by_tree.setdefault(t, []).append(j)

            def whole(t: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
                for j in by_tree.get(t, []):
                    yield (place[np.frombuffer(given.column("rows")[j].as_buffer(), np.int32)], np.frombuffer(given.column("found")[j].as_buffer(), float))

            x = bins.matrix(rows)
            return rows.select(list(range(rows.num_columns - 2))).append_column(out, pa.array(at_tops(x, whole)))

        cores = df.sparkSession.sparkContext.defaultParallelism
        tasks = min(int(copies.sum()), max(4 * cores, sum(reached.values()) // VISIT_ROWS))
        often = pa.table({"slot": pa.array(range(len(copies)), pa.int32()), "copies": pa.array(copies.astype(np.int32))})
        parts = self.parts.join(F.broadcast(df.sparkSession.createDataFrame(often)), "slot").withColumn(
            "copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
        sent = seen.mapInArrow(send, "slot int, copy int, block long, rows binary, x binary").repartition(tasks, "slot", "copy")
        given = sent.groupBy("slot", "copy").cogroup(parts.repartition(tasks, "slot", "copy").groupBy("slot", "copy")).applyInArrow(
            visit, "block long, tree int, rows binary, found binary")
        blocks = max(cores, placed.rdd.getNumPartitions())
        return placed.repartition(blocks, "__block").groupBy("__block").cogroup(
            given.withColumnRenamed("block", "__block").repartition(blocks, "__block").groupBy("__block")).applyInArrow(gather, final)

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per tree with its top and the bins, and one per part."""
        tops = pa.table([pa.array(range(len(self.tops)), pa.int32()), *[pa.concat_arrays(c) for c in zip(*[_lists(t) for t in self.tops])]],
                        names=["tree", "feature", "cut", "left", "right", "value"]) if self.tops else None
        rows = spark.createDataFrame(tops) if tops else spark.createDataFrame([], f"tree int, {NODES}")
        rows = rows.select(F.lit(-1).alias("slot"), "tree", F.lit(-1).alias("node"), *rows.columns[1:], F.lit(json.dumps(vars(self.bins))).alias("bins"))
        if self.places:
            slots = pa.table({"slot": pa.array(range(len(self.places)), pa.int32()), "tree": pa.array([t for t, _ in self.places], pa.int32()),
                              "node": pa.array([n for _, n in self.places], pa.int32())})
            named = self.parts.join(F.broadcast(spark.createDataFrame(slots)), "slot")
            rows = rows.unionByName(named.withColumn("bins", F.lit(None).cast("string")).select(*rows.columns))
        rows.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> ForestModel:
        rows = spark.read.parquet(path)
        tops = rows.filter("slot < 0").orderBy("tree").toArrow().combine_chunks()
        places = [(r["tree"], r["node"]) for r in rows.filter("slot >= 0").select("slot", "tree", "node").orderBy("slot").collect()]
        trees = [_tree_at(tops, k) for k in range(tops.num_rows)]
        bins = Bins(**json.loads(tops.column("bins")[0].as_py())) if trees else Bins([], [], [], [])
        return ForestModel(bins, trees, places, rows.filter("slot >= 0").select("slot", "feature", "cut", "left", "right", "value") if places else None)


def _rows(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (b.column("label").to_numpy(), b.column("h").to_numpy(), np.stack([c.to_numpy() for c in b.columns[2:]], axis=1))


def _level(binned: DataFrame, trees: list[Tree], wanted: list[tuple[int, int]], bins: Bins, bag: Bagging, tasks: int) -> np.ndarray:
    """(nodes, bins, 2) for the (tree, node) of ``wanted``, in one job."""
    width, numeric = int(bins.offsets[-1]), len(bins.numeric)
    named: dict[int, np.ndarray] = {}
    for slot, (t, node) in enumerate(wanted):
        named.setdefault(t, np.full(len(trees[t].feature), -1))[node] = slot
    used = {t: trees[t] for t in named}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(wanted), width, 2), np.int64)
        for b in batches:
            label, h, x = _rows(b)
            for t, slot_of in named.items():
                slot, w = slot_of[used[t].nodes(x, numeric)], bag_weights(h, bag.seed, t)
                keep = (slot >= 0) & (w > 0)
                mine = np.unique(slot[keep])
                if len(mine):
                    total[mine] += _bin_sums(np.searchsorted(mine, slot[keep]), x[keep], (w * label)[keep], w[keep], len(mine), bins.offsets)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(wanted)), pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())],
                                         names=["slot", "sums"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, s in zip(b.column("slot").to_pylist(), b.column("sums").to_pylist()):
                held[k] = held.get(k, 0) + np.frombuffer(s, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([s.tobytes() for s in held.values()], pa.binary())],
                                         names=["slot", "sums"])

    schema = "slot int, sums binary"
    parts = binned.mapInArrow(run, schema).repartition(min(tasks, len(wanted)), "slot").mapInArrow(join, schema)
    out = np.zeros((len(wanted), width, 2), np.int64)
    for r in parts.collect():  # JOB_NODES x bins numbers
        out[r["slot"]] = np.frombuffer(r["sums"], np.int64).reshape(width, 2)
    return out


def _finish(binned: DataFrame, trees: list[Tree], small: list[tuple[int, int, int, int]], bins: Bins, bag: Bagging, rows: int) -> DataFrame:
    """slot and ``NODES``: the tree below each (tree, node, path, depth) of ``small``. Rows travel as bytes, those of a batch in a slot together."""
    numeric, narrow = len(bins.numeric), narrowest(bins)
    named = _slots(trees, [(t, node) for t, node, _, _ in small])
    used = {t: trees[t] for t in named}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, BLOCK_ROWS):
            label, h, x = _rows(b)
            x = x.astype(narrow)
            for t, slot_of in named.items():
                w = bag_weights(h, bag.seed, t)
                groups = list(by_slot(np.where(w > 0, slot_of[used[t].nodes(x, numeric)], -1)))
                if groups:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s for s, _ in groups], pa.int32()), pa.array([w[r].astype(np.uint8).tobytes() for _, r in groups], pa.binary()),
                         pa.array([label[r].astype(np.uint8).tobytes() for _, r in groups], pa.binary()),
                         pa.array([x[r].tobytes() for _, r in groups], pa.binary())], names=["slot", "w", "y", "x"])

    def grow(table: pa.Table) -> pa.Table:
        slot = table.column("slot")[0].as_py()
        joined = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
        w = joined("w", np.uint8).astype(float)
        wy, x = w * joined("y", np.uint8), joined("x", narrow).reshape(-1, len(bins.sizes)).astype(np.int32)
        _, _, path, depth = small[slot]
        tree = grow_to_the_end(x, wy, w, path, None if bag.depth is None else bag.depth - depth, bins, bag)
        return pa.table([pa.array([slot], pa.int32()), *_lists(tree)], names=["slot", "feature", "cut", "left", "right", "value"])

    cores = binned.sparkSession.sparkContext.defaultParallelism
    tasks = min(len(small), max(4 * cores, rows * len(named) // TASK_ROWS))
    sent = binned.mapInArrow(send, "slot int, w binary, y binary, x binary").repartition(tasks, "slot")
    return sent.groupBy("slot").applyInArrow(grow, f"slot int, {NODES}")


def _graft(tree: Tree, node: int, part: Tree) -> Tree:
    """``tree`` with what ``part`` grew in place of the leaf ``node``; all columns become arrays."""
    base = len(tree.feature) - 1  # the root of the part takes the place of the leaf
    number = np.r_[node, np.arange(1, len(part.feature)) + base]
    columns = {}
    for name in ("feature", "cut", "left", "right", "value"):
        own, new = np.asarray(getattr(tree, name)), np.asarray(getattr(part, name))
        new = number[new] if name in ("left", "right") else new
        columns[name] = np.concatenate([own, new[1:]])
        columns[name][node] = new[0]
    return Tree(**columns)


def fit_forest(df: DataFrame, bag: Bagging, numeric: Sequence[str], categories: Sequence[str] = (), label: str = "label",
               id_cols: Sequence[str] = ()) -> ForestModel:
    """A forest for a label of 0 or 1.

    Rows without a label are left out; missing numbers count as 0, missing categories are a
    category. Weights follow the hash of ``id_cols`` (all columns if not given), so rows that
    repeat them are drawn together. Without rows the score is 0. A part of a tree has less than
    twice as many nodes as rows; one of more than ``MOST_NODES`` would not fit in a task and is an
    error that asks for a larger ``min_rows``. Runs jobs when called: three tables are written, the
    last of which is the forest and stays where intermediate tables are unless it is saved.
    """
    columns = list(dict.fromkeys([*numeric, *categories, label, *id_cols]))
    rows = persist_table(df.select(*columns).filter(F.col(label).isNotNull()).fillna(0.0, subset=list(numeric)))
    n = rows.count()
    if not n:
        return ForestModel(Bins(list(numeric), [[] for _ in numeric], list(categories), [[] for _ in categories]), [])
    keys = list(id_cols) or columns
    bins = find_bins(rows, n, numeric, categories, keys, bag.bins)
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_ROWS))
    k = len(bins.sizes)

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = bins.matrix(b)
            yield pa.RecordBatch.from_arrays([b.column(label).cast(pa.int64()), b.column("__h"), *[pa.array(x[:, j]) for j in range(k)]],
                                             names=["label", "h", *[f"b{j}" for j in range(k)]])

    schema = "label long, h long" + "".join(f", b{j} int" for j in range(k))
    binned = persist_table(rows.withColumn("__h", id_number(*keys)).repartition(tasks).mapInArrow(to_bins, schema))

    trees = [Tree() for _ in range(bag.trees)]
    roots = root_paths(bag.seed, bag.trees)
    small = [(t, 0, roots[t], 0) for t in range(bag.trees)] if n <= LOCAL_ROWS else []
    large = [] if n <= LOCAL_ROWS else [(t, 0, roots[t], 0) for t in range(bag.trees)]
    while large:
        deeper = []
        for start in range(0, len(large), JOB_NODES):
            some = large[start:start + JOB_NODES]
            sums = _level(binned, trees, [(t, node) for t, node, _, _ in some], bins, bag, tasks)
            total = sums[:, :bins.offsets[1]].sum(1)
            feature, cut, upper = best_cuts(sums, np.array([p for _, _, p, _ in some], np.int64), bins, bag)
            for (t, node, path, depth), f, c, all_, high in zip(some, feature.tolist(), cut.tolist(), total.tolist(), upper.tolist()):
                trees[t].value[node] = all_[0] / max(1, all_[1])
                if f < 0 or (bag.depth is not None and depth >= bag.depth):
                    continue
                low = [a - b for a, b in zip(all_, high)]
                nodes = trees[t].split(node, f, c, (low[0] / low[1], high[0] / high[1]))
                for child, p, part in zip(nodes, (int(q[0]) for q in child_paths(np.array([path], np.int64))), (low, high)):
                    if 0 < part[0] < part[1] and part[1] >= 2 * bag.min_rows and (bag.depth is None or depth + 1 < bag.depth):
                        (small if part[1] <= LOCAL_ROWS else deeper).append((t, child, p, depth + 1))
        large = deeper
    if small:
        parts = persist_table(_finish(binned, trees, small, bins, bag, n))
        size = parts.agg(F.max(F.size("feature"))).first()[0]
        if size > MOST_NODES:
            raise ValueError(f"a part of the forest has {size} nodes; a larger min_rows makes it smaller")
        return ForestModel(bins, trees, [(t, node) for t, node, _, _ in small], parts)
    return ForestModel(bins, trees)
