"""Mines hard negatives: rows of another label that score nearly as high for an anchor as its own positives.

Scores are integer inner products. With one more component, the root of what a row's squared length lacks of the
largest one, all rows are equally long; an anchor gets zero there. The higher a row scores, the nearer it then is to
the anchor, so that the wanted scores are an annulus around it, and the triangle inequality holds.

The index is a tree of the GNAT kind. An inner node has several split points, each row goes to the nearest of them,
and for every split point the node stores the smallest and largest distance to the rows of each sibling's subtree.
From an anchor's distance to a split point and that range follow a least and a largest distance to the subtree; if
they miss the annulus for any split point, the subtree is left out. The split points come from a bounded sample, the
ranges and the leaves from all rows. Rows of the leaves that remain are scored exactly.

Searches run as Spark jobs: leaves are cut into blocks of bounded size, anchors too, and a task holds one of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanewatch.scratch import settle

POSITIVES = NEGATIVES = 5
# a negative's score in hundredths of the positive's, at least
NEAR = 80
# components are multiplied with this and rounded down
SCALE = 256

# Rows that split points are chosen from (by smallest hash); the tree's size follows from it.
SAMPLE = 4096
SPLIT_POINTS = 8
# Rows of the sample in a leaf at most.
LEAF_SAMPLE = 64
# Rows of a block of a leaf, and anchors of a block.
BLOCK_ROWS = 20_000
BLOCK_ANCHORS = 4096
# Scores computed at a time, 8 bytes each.
CELLS = 1 << 22
# Share of the largest length by which computed distances may be off.
SLACK = 1e-6


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


@dataclass
class Node:
    points: np.ndarray
    # of each split point, the child's place among the nodes, or the leaf's number as -1 - leaf
    children: list[int] = field(default_factory=list)
    # smallest and largest distance of split point i to the rows of child j
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class Tree:
    """Split points of all inner nodes; the first one is the root. Without nodes there is one leaf, 0."""

    def __init__(self, sample: np.ndarray):
        self.nodes: list[Node] = []
        self.leaves = 0
        self._grow(sample)

    def _grow(self, sample: np.ndarray) -> int:
        points = self._split_points(sample) if len(sample) > LEAF_SAMPLE else sample[:0]
        if len(points) < 2:
            self.leaves += 1
            return -self.leaves
        place = len(self.nodes)
        node = Node(points)
        self.nodes.append(node)
        nearest = distances(sample, points).argmin(axis=1)
        for j in range(len(points)):
            node.children.append(self._grow(sample[nearest == j]))
        return place

    @staticmethod
    def _split_points(sample: np.ndarray) -> np.ndarray:
        """Rows far apart: each the one farthest from those before it."""
        chosen = [0]
        far = distances(sample, sample[:1])[:, 0]
        while len(chosen) < SPLIT_POINTS:
            best = int(far.argmax())
            if far[best] <= 0:
                break
            chosen.append(best)
            far = np.minimum(far, distances(sample, sample[best : best + 1])[:, 0])
        return sample[chosen]

    def place_rows(self, rows: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, float, float]]]:
        """The leaf of each row, and ranges (node, split point, child, smallest, largest distance) of these rows."""
        leaf = np.zeros(len(rows), np.int64)
        ranges: list[tuple[int, int, int, float, float]] = []
        todo = [(0, np.arange(len(rows)))] if self.nodes else []
        while todo:
            place, at = todo.pop()
            node = self.nodes[place]
            apart = distances(rows[at], node.points)
            nearest = apart.argmin(axis=1)
            for j, child in enumerate(node.children):
                own = nearest == j
                if not own.any():
                    continue
                low, high = apart[own].min(axis=0), apart[own].max(axis=0)
                ranges += [(place, i, j, float(low[i]), float(high[i])) for i in range(len(node.points))]
                if child < 0:
                    leaf[at[own]] = -1 - child
                else:
                    todo.append((child, at[own]))
        return leaf, ranges

    def set_ranges(self, ranges: list[tuple[int, int, int, float, float]]) -> None:
        for node in self.nodes:
            size = (len(node.points), len(node.points))
            # a child without rows is never met
            node.low, node.high = np.full(size, np.inf), np.full(size, -np.inf)
        for place, i, j, low, high in ranges:
            self.nodes[place].low[i, j], self.nodes[place].high[i, j] = low, high

    def leaves_met(self, anchors: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """Places of those anchors whose annulus from ``inner`` to ``outer`` may hold rows of a leaf, and the leaf."""
        if not self.nodes:
            yield np.arange(len(anchors)), 0
        todo = [(0, np.arange(len(anchors)))] if self.nodes and len(anchors) else []
        while todo:
            place, at = todo.pop()
            node = self.nodes[place]
            apart = distances(anchors[at], node.points)
            for j, child in enumerate(node.children):
                least = np.maximum(apart - node.high[:, j], node.low[:, j] - apart).max(axis=1)
                most = (apart + node.high[:, j]).min(axis=1)
                meets = at[(least <= outer[at]) & (most >= inner[at])]
                if len(meets) and child < 0:
                    yield meets, -1 - child
                elif len(meets):
                    todo.append((child, meets))


def integer_rows(rows: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """``id``, ``label``, ``v``: whole components, all rows equally long with zeros at the end; see ``mine_negatives``."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    plain = rows.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.when(~bad, F.transform(x, lambda c: F.floor(c * F.lit(float(SCALE))).cast("long"))).alias("v"),
    ).filter("id is not null and label is not null and v is not null")
    once = settle(plain.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row")).select("id", "row.label", "row.v"))
    size = once.agg(F.max(F.size("v"))).first()[0] or 0
    return once.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("v"))))


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _longer(vectors: np.ndarray, square: float) -> np.ndarray:
    """Rows with the component that makes their squared length ``square``."""
    vectors = vectors.astype(np.float64)
    lacks = np.maximum(square - (vectors * vectors).sum(axis=1), 0)
    return np.hstack([vectors, np.sqrt(lacks)[:, None]])


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products: as doubles where all sums are whole numbers below 2^53, else as 64-bit integers."""
    largest = [float(np.abs(m).max(initial=0)) for m in (rows, anchors)]
    if largest[0] * largest[1] * max(rows.shape[1], 1) < 2.0**53:
        return (rows.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    return rows @ anchors.T


class Index:
    """Rows in the leaves of a tree, on Spark: ``leaf``, ``block``, ``id``, ``label``, ``v``."""

    def __init__(self, rows: DataFrame):
        self.spark = rows.sparkSession
        length = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
        self.square = float(rows.agg(F.max(length)).first()[0] or 0.0)
        self.slack = SLACK * (math.sqrt(self.square) + 1)
        sample = rows.select("v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
        tree = Tree(_longer(_matrix(sample.column("v")), self.square))
        placed = settle(self._placed(rows, tree))
        # one row for each pair of split point and child, so as many as the sample allows
        ranges = placed.filter("low is not null").groupBy("node", "point", "child").agg(F.min("low"), F.max("high"))
        tree.set_ranges([tuple(r) for r in ranges.collect()])
        self.tree = self.spark.sparkContext.broadcast(tree)
        inside = placed.filter("id is not null").select("leaf", "id", "label", "v")
        sizes = inside.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
        self.blocks = settle(sizes)
        self.rows = settle(
            inside.join(F.broadcast(self.blocks), "leaf")
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
            .select("leaf", "block", "id", "label", "v")
        )

    def _placed(self, rows: DataFrame, tree: Tree) -> DataFrame:
        shared, square = self.spark.sparkContext.broadcast(tree), self.square

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: dict[tuple[int, int, int], tuple[float, float]] = {}
            for batch in batches:
                leaf, ranges = shared.value.place_rows(_longer(_matrix(batch.column(2)), square)) if batch.num_rows else ([], [])
                for *key, low, high in ranges:
                    least, most = seen.get(tuple(key), (low, high))
                    seen[tuple(key)] = min(low, least), max(high, most)
                none = pa.nulls(batch.num_rows, pa.int64())
                bare = pa.nulls(batch.num_rows, pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf, pa.int64()), *batch.columns, none, none, none, bare, bare], schema=schema
                )
            rows_of = [(*key, *span) for key, span in seen.items()]
            found = list(zip(*rows_of)) if rows_of else [()] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            n = len(rows_of)
            empty = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*empty, *(pa.array(c, t) for c, t in zip(found, types))], schema=schema)

        names = ("leaf", "id", "label", "v", "node", "point", "child", "low", "high")
        kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] + [pa.int64()] * 3 + [pa.float64()] * 2
        schema = pa.schema(list(zip(names, kinds)))
        return rows.select("id", "label", "v").mapInArrow(
            run, "leaf long, id long, label long, v array<long>, node long, point long, child long, low double, high double"
        )

    def search(self, probes: DataFrame, most: int, same_label: bool, own_leaf: bool = False) -> DataFrame:
        """``anchor``, ``probe``, ``id``, ``score``: the first ``most`` rows of each probe, by score and then id.

        ``probes`` has ``anchor``, ``label``, ``v``, a number ``probe``, and the wanted scores, from ``least`` to
        ``most_score``, null where there is no bound. Rows have the anchor's label, or another one; the anchor
        itself is no row of its own. ``own_leaf`` looks into the leaf alone that the anchor itself lies in.
        """
        blocks = max(1, math.ceil(probes.select("anchor").distinct().count() / BLOCK_ANCHORS))
        met = self._leaves(probes, own_leaf).withColumn("anchors", F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
        met = met.join(F.broadcast(self.blocks), "leaf")
        met = met.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
        rows = self.rows.withColumn("anchors", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

        def score(left: pa.Table, right: pa.Table) -> pa.Table:
            return _first_of(left, right, most, same_label)

        group = ["leaf", "block", "anchors"]
        found = (
            rows.groupBy(*group)
            .cogroup(met.groupBy(*group))
            .applyInArrow(score, "anchor long, probe long, id long, score long")
        )
        rank = F.row_number().over(Window.partitionBy("anchor", "probe").orderBy(F.desc("score"), "id"))
        return found.withColumn("rank", rank).filter(F.col("rank") <= most)

    def _leaves(self, probes: DataFrame, own_leaf: bool) -> DataFrame:
        """Probes with each leaf that they have to look into."""
        shared, square, slack = self.tree, self.square, self.slack
        columns = ["anchor", "label", "v", "probe", "least", "most_score"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                # a probe may go to all leaves, so few at a time
                for start in range(0, whole.num_rows, 256):
                    batch = whole.slice(start, 256)
                    vectors = _matrix(batch.column(2))
                    if own_leaf:
                        leaf, _ = shared.value.place_rows(_longer(vectors, square))
                        at = np.arange(batch.num_rows)
                    else:
                        plain = vectors.astype(np.float64)
                        anchors = np.hstack([plain, np.zeros((len(plain), 1))])
                        whole_square = (plain * plain).sum(axis=1) + square
                        least, top = _bounds(batch.column(4), batch.column(5))
                        outer = np.sqrt(np.maximum(whole_square - 2.0 * least, 0)) + slack
                        inner = np.sqrt(np.maximum(whole_square - 2.0 * top, 0)) - slack
                        pairs = list(shared.value.leaves_met(anchors, inner, outer))
                        at = np.concatenate([p for p, _ in pairs]) if pairs else np.zeros(0, np.int64)
                        leaf = np.concatenate([np.full(len(p), n) for p, n in pairs]) if pairs else at
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(leaf, pa.int64()), *batch.take(pa.array(at, pa.int64())).columns], names=["leaf", *columns]
                    )

        return probes.select(*columns).mapInArrow(
            run, "leaf long, anchor long, label long, v array<long>, probe long, least long, most_score long"
        )


def _bounds(least: pa.Array, most: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Wanted scores; a null is no bound."""
    limits = np.iinfo(np.int64)
    return np.asarray(least.fill_null(limits.min), np.int64), np.asarray(most.fill_null(limits.max), np.int64)


def _first_of(rows: pa.Table, probes: pa.Table, most: int, same_label: bool) -> pa.Table:
    """The first rows of a block for each probe."""
    out: list[tuple[np.ndarray, ...]] = []
    if rows.num_rows and probes.num_rows:
        vectors = _matrix(rows.column("v"))
        ids, labels = (rows.column(c).to_numpy() for c in ("id", "label"))
        anchor, label, probe = (probes.column(c).to_numpy() for c in ("anchor", "label", "probe"))
        least, top = _bounds(probes.column("least"), probes.column("most_score"))
        names, first = np.unique(anchor, return_index=True)
        column = np.searchsorted(names, anchor)
        wanted = _matrix(probes.column("v").take(pa.array(first)))
        step = max(1, CELLS // len(ids))
        order = np.argsort(column, kind="stable")
        for lo in range(0, len(names), step):
            scores = products(vectors, wanted[lo : lo + step]).T.copy()
            for p in order[np.searchsorted(column[order], lo) : np.searchsorted(column[order], lo + step)]:
                own = scores[column[p] - lo]
                fits = (labels == label[p]) == same_label
                fits &= ids != anchor[p]
                fits &= (own >= least[p]) & (own <= top[p])
                at = np.flatnonzero(fits)
                if len(at) > most:
                    at = at[own[at] >= np.partition(own[at], len(at) - most)[len(at) - most]]
                at = at[np.lexsort((ids[at], -own[at]))[:most]]
                out.append((np.full(len(at), anchor[p]), np.full(len(at), probe[p]), ids[at], own[at]))
    columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
    return pa.Table.from_arrays([pa.array(c) for c in columns], names=["anchor", "probe", "id", "score"])


def mine_negatives(
    rows: DataFrame,
    anchors: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    near: int = NEAR,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are the rows for which the condition ``anchors`` on the column ``id`` holds. An anchor's positives are
    the first other rows of its label; a positive's negatives are the first rows of other labels that score no more
    than it, and ``near`` hundredths of it or more. Higher scores come first, then smaller ids. A positive without
    such rows gives none.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part. Rows that
    repeat an id count once, by the smallest label and vector. Vectors may differ in length: missing components are
    zero. Scores have to fit 64 bits. An empty table gives an empty result; other columns are not read.
    """
    found = integer_rows(rows, id_column, vector, label)
    index = Index(found)
    asked = settle(found.filter(anchors).select(F.col("id").alias("anchor"), "label", "v"))
    no_bound = F.lit(None).cast("long")
    probes = asked.withColumns({"probe": F.lit(0).cast("long"), "least": no_bound, "most_score": no_bound})

    # the own leaf tells how far an anchor has to look for its positives
    nearby = index.search(probes, positives, same_label=True, own_leaf=True)
    bound = nearby.groupBy("anchor").agg(F.when(F.count("*") == positives, F.min("score")).alias("bound"))
    probes = probes.join(bound, "anchor", "left").withColumn("least", F.col("bound")).drop("bound")
    first = settle(index.search(probes, positives, same_label=True))

    # least whole score of the window; a negative positive's window is empty
    wide = F.col("score").cast("decimal(28,0)") * F.lit(int(near)).cast("decimal(9,0)")
    least = F.ceil(wide / F.lit(100).cast("decimal(3,0)")).cast("long")
    windows = first.select("anchor", F.col("id").alias("probe"), least.alias("least"), F.col("score").alias("most_score"))
    windows = windows.filter("least <= most_score").join(asked, "anchor")
    hard = index.search(windows, negatives, same_label=False)
    positive = first.select("anchor", F.col("id").alias("probe"), F.col("score").alias("positive_score"))
    return hard.join(positive, ["anchor", "probe"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("probe").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
