"""Hard negatives by an R-tree, packed by sort-tile-recursive.

Spark sorts the rows by label and the coordinate of the largest variance into
slabs (a range partitioning, ties by hash, so that one repeated vector spreads);
each slab is tiled by the next coordinates into leaves of ``LEAF`` rows of one
label, and ``FANOUT`` leaves are a node, one row of the stored tree. A minimum
bounding box bounds the inner product with an anchor from both sides: each
coordinate adds the least and the greatest product of its interval.

Anchors are searched in blocks of at most ``ANCHORS``, shipped to all tasks.
A task searches its part of the tree for each anchor with a best-first queue by
upper bound and leaves out boxes outside all score windows and boxes strictly
below the k-th score of all windows; what the tasks find is merged by Spark.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drivesync.llm.common import released, stored
from drivesync.llm.vectors import matrix, usable

SCALE = 256
LEAF = 128
FANOUT = 16
SLAB_ROWS = 8192
# Coordinates a slab is tiled by.
TILED = 3
ANCHORS = 16384
# Nodes of the tree a task holds at a time, anchors whose bounds it holds at a time.
HELD_NODES = 64
HELD_ANCHORS = 256

_NODE = "label long, ids binary, vectors binary"


def tiled(rows: np.ndarray, axes: list) -> np.ndarray:
    """Order of the rows in which ``LEAF`` consecutive ones are a tile."""
    def order(index, axes):
        leaves = -(-len(index) // LEAF)
        if leaves <= 1 or not axes:
            return [index]
        index = index[np.argsort(rows[index, axes[0]], kind="stable")]
        slabs = int(np.ceil(leaves ** (1 / len(axes))))
        step = -(-leaves // slabs) * LEAF
        return [part for at in range(0, len(index), step) for part in order(index[at : at + step], axes[1:])]

    return np.concatenate(order(np.arange(len(rows)), list(axes)))


def build(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """The tree of ``vec_id, label, vector``: a row a node, its leaves one after another."""
    spread = rows.select(F.posexplode("vector")).groupBy("pos").agg(F.var_pop("col").alias("v")).collect()
    axes = [r.pos for r in sorted(spread, key=lambda r: (-r.v, r.pos))]
    if not axes:
        return rows.sparkSession.createDataFrame([], _NODE)
    slabs = max(1, -(-rows.count() // SLAB_ROWS))

    def run(batches):
        held = list(batches)
        if not held:
            return
        labels, ids = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("label", "vec_id"))
        vectors = np.concatenate([matrix(b.column("vector"), scale) for b in held])
        for label in np.unique(labels):
            mine = np.flatnonzero(labels == label)
            mine = mine[tiled(vectors[mine], axes[1 : 1 + TILED])]
            nodes = [mine[at : at + LEAF * FANOUT] for at in range(0, len(mine), LEAF * FANOUT)]
            yield pa.RecordBatch.from_arrays([
                pa.array([label] * len(nodes), pa.int64()), pa.array([ids[n].astype("<i8").tobytes() for n in nodes], pa.binary()),
                pa.array([vectors[n].astype("<i4").tobytes() for n in nodes], pa.binary())], names=["label", "ids", "vectors"])

    ranged = rows.repartitionByRange(slabs, "label", F.get("vector", F.lit(axes[0])), F.xxhash64("vec_id"))
    return stored(ranged.mapInArrow(released(run), _NODE), "rtree")


class Boxes:
    """Minimum bounding boxes of runs of rows."""

    def __init__(self, rows, begin):
        self.least, self.most = np.minimum.reduceat(rows, begin), np.maximum.reduceat(rows, begin)

    def bounds(self, anchors):
        """(lower, upper) of the inner products, anchors x boxes."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return up @ self.least.T + down @ self.most.T, up @ self.most.T + down @ self.least.T


class Tree:
    """Some nodes of the tree, with boxes of nodes and leaves."""

    def __init__(self, labels, ids, vectors, size):
        sizes = np.array([len(i) // 8 for i in ids])
        self.labels = np.array(labels)
        self.ids = np.frombuffer(b"".join(ids), "<i8")
        self.rows = np.frombuffer(b"".join(vectors), "<i4").reshape(-1, size).astype(np.float64)
        first = np.cumsum(sizes) - sizes
        begins = [np.arange(at, at + n, LEAF) for at, n in zip(first, sizes)]
        self.begin = np.concatenate(begins)
        self.end = np.append(self.begin[1:], len(self.rows))
        count = np.array([len(b) for b in begins])
        self.leaf_from, self.leaf_to = np.cumsum(count) - count, np.cumsum(count)
        self.nodes, self.leaves = Boxes(self.rows, first), Boxes(self.rows, self.begin)

    def search(self, anchors, labels, same, best):
        """Put what is found for each anchor into its ``Best``; rows of its own label, or of all others."""
        for at in range(0, len(anchors), HELD_ANCHORS):
            part = slice(at, at + HELD_ANCHORS)
            bounds = [*self.nodes.bounds(anchors[part]), *self.leaves.bounds(anchors[part])]
            for i, (low, high, leaf_low, leaf_high) in enumerate(zip(*bounds)):
                found = best[at + i]
                if found is not None:
                    allowed = np.flatnonzero((self.labels == labels[at + i]) == same)
                    self._one(anchors[at + i], allowed, low, high, leaf_low, leaf_high, found)

    def _one(self, anchor, allowed, low, high, leaf_low, leaf_high, found):
        queue = [(-high[n], 0, n) for n in allowed[found.useful(low[allowed], high[allowed])].tolist()]
        heapq.heapify(queue)
        while queue:
            bound, is_leaf, at = heapq.heappop(queue)
            if -bound < found.floor:
                return
            if is_leaf:
                part = slice(self.begin[at], self.end[at])
                found.add(self.rows[part] @ anchor, self.ids[part])
            else:
                leaves = np.arange(self.leaf_from[at], self.leaf_to[at])
                for leaf in leaves[found.useful(leaf_low[leaves], leaf_high[leaves])].tolist():
                    heapq.heappush(queue, (-leaf_high[leaf], 1, leaf))


class Best:
    """The first ``k`` rows in each of some score windows, by falling score, then id."""

    def __init__(self, low, high, k):
        self.low, self.high, self.k = np.array(low, float)[:, None], np.array(high, float)[:, None], k
        self.held = [(np.zeros(0), np.zeros(0, np.int64)) for _ in low]
        self.floors = self.low.copy()
        self.floor = self.low.min()

    def useful(self, low, high):
        return ((high >= self.floors) & (low <= self.high)).any(0)

    def add(self, scores, ids):
        fits = (scores >= self.floors) & (scores <= self.high)
        for w in np.flatnonzero(fits.any(1)):
            s, i = (np.concatenate([old, new[fits[w]]]) for old, new in zip(self.held[w], (scores, ids)))
            first = np.lexsort((i, -s))[: self.k]
            self.held[w] = s[first], i[first]
            if len(first) == self.k:
                self.floors[w] = max(self.floors[w, 0], s[first[-1]])
        self.floor = self.floors.min()


def _found(tree: DataFrame, block, windows, same: bool, k: int) -> DataFrame:
    """``anchor, window, score, id, place``: the first ``k`` of each window of each anchor.

    ``block`` is a broadcast of (vectors, labels); ``windows`` one of a (low, high) pair
    of lists an anchor.
    """
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("anchor", "window", "score", "id")])

    def run(batches):
        anchors, labels = block.value
        best = [Best(low, high, k) if low else None for low, high in windows.value]
        for batch in batches:
            for at in range(0, batch.num_rows, HELD_NODES):
                nodes = batch.slice(at, HELD_NODES)
                columns = [nodes.column(c).to_pylist() for c in ("label", "ids", "vectors")]
                Tree(*columns, anchors.shape[1]).search(anchors, labels, same, best)
        rows = [(a, w, s, i) for a, b in enumerate(best) if b for w, (scores, ids) in enumerate(b.held)
                for s, i in zip(scores.tolist(), ids.tolist())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.array(c).astype(np.int64)) for c in zip(*rows)], names=schema.names)

    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return tree.mapInArrow(released(run), schema).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of
    ``vec_id, label, vector`` (``usable`` rows, no nulls).

    Anchors are the rows whose id is divisible by ``every``; anchors equal in id, label and
    vector answer once. Each other row counts, repeated ones too. A negative has ``low`` to
    ``high`` percent of the positive's score; a negative positive score has none.
    """
    spark = rows.sparkSession
    tree = build(rows, scale)
    anchors = stored(rows.where(F.col("vec_id") % every == 0).distinct(), "anchors")
    blocks = max(1, -(-anchors.count() // ANCHORS))
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    result = None
    for number in range(blocks):
        taken = anchors.where(F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks)) == number).toArrow()
        vectors = matrix(taken.column("vector").combine_chunks(), scale)
        ids = taken.column("vec_id").to_numpy()
        block = spark.sparkContext.broadcast((vectors, taken.column("label").to_numpy()))
        everything = spark.sparkContext.broadcast([([-np.inf], [np.inf])] * len(ids))
        ranked = [[] for _ in ids]
        # One more than asked for, as the anchor itself may be among them.
        for r in _found(tree, block, everything, True, positives + 1).orderBy("anchor", "place").collect():
            ranked[r.anchor].append((r.score, r.id))
        for a, found in enumerate(ranked):
            itself = (int(vectors[a] @ vectors[a]), int(ids[a]))
            if itself in found:
                found.remove(itself)
            del found[positives:]
        windows = [([-(-low * s // 100) for s, _ in found], [high * s // 100 for s, _ in found]) for found in ranked]
        windows = spark.sparkContext.broadcast(windows)
        pairs = [(a, w, int(ids[a]), i, s) for a, found in enumerate(ranked) for w, (s, i) in enumerate(found)]
        asked = spark.createDataFrame(
            pa.table([pa.array(c, pa.int64()) for c in (zip(*pairs) if pairs else [[]] * 5)],
                     names=["anchor", "window", "anchor_id", "positive_id", "positive_score"]))
        part = _found(tree, block, windows, False, negatives).join(asked, ["anchor", "window"]).select(
            "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"))
        part = stored(part.select(*names), "negatives")
        for shipped in (block, everything, windows):
            shipped.unpersist()
        result = part if result is None else result.unionByName(part)
    return result


def hard_negatives(rows: DataFrame) -> DataFrame:
    """Hard negatives of ``vec_id, embedding, label``, see ``mine``.

    Rows with a null id, label or vector, an empty vector, a null or non-finite
    component, or another length than that of the least ``vec_id`` take no part.
    The label of rows whose id is divisible by 7 first becomes (label + 1) % 10.
    Components beyond +-8192 count as that. An empty table gives no rows.
    """
    known = rows.where("vec_id is not null and label is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long")).alias("label"))
    return mine(usable(known))
