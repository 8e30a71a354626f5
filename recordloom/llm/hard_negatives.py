"""Hard negatives by cover trees: rows of other labels whose inner product with an anchor lies below that of its positives.

Components become ``floor(scale * x)``, so scores are whole numbers. Rows are cut into blocks of at most ``BLOCK_ROWS``, sorted by
label, and a task builds a cover tree of each. To it, every vector gets one more component that brings all of a block to one
norm; distances then order as inner products do. The tree is that of a farthest-first order: the points placed before the
distance falls to 2^l are more than 2^l apart and cover the block within 2^l, and a later point hangs below the nearest of those
before its level. For a point and a level the tree keeps the covering radius, the distance of the farthest point below it
from that level on. With it, an anchor's distance to the point bounds the inner products of all of them. A search descends into
the group of points with the highest upper bound first, leaves out groups whose bounds meet no window or can't reach a
window's worst row so far, and computes the scores of the points it meets exactly.

A first search finds the positives of each anchor: the rows of its label with the highest scores. Their scores open the
windows of the second search, over rows of other labels. Blocks of anchors meet blocks of rows as groups of a join; each
block's best rows meet per anchor in a window function. Ties go to the smaller id.

Rows take no part whose label, vector or any component is null or not finite. Rows of other lengths than an anchor's, and
rows with its own id, are nothing to it. Of several anchors with one id, the one with the smallest label and vector asks; other
repeated rows count as often. A null id asks nothing and answers as the largest id. Empty tables give empty results, an anchor
without positives or negatives no rows. Vectors whose scores might not fit 64 bits are refused. Only ``vec_id``,
``embedding`` and ``label`` are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.session import stage

BLOCK_ROWS, ANCHOR_ROWS = 2048, 1024
_NO_ID = (1 << 63) - 1
#: Sums of products stay exact in double precision below this.
_EXACT = 1 << 53


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id, label, width, vector``: rows that take part, with whole components."""
    plain = vectors.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(_NO_ID)).alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    whole = F.transform("vector", lambda x: F.floor(x * scale).cast("long"))
    return plain.filter(F.col("label").isNotNull() & finite).select("vec_id", "label", F.size("vector").alias("width"), whole.alias("vector"))


def _augmented(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """Vectors with one more component that gives all the same norm, and the square of it."""
    x = vectors.astype(np.float64)
    squares = (x * x).sum(axis=1)
    norm = squares.max(initial=0)
    return np.column_stack((x, np.sqrt(norm - squares))), float(norm)


def build_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``parent, level, reach`` of distinct points: -1 for the root; the radius that the parent's group of that level covers."""
    x, norm = _augmented(vectors)
    n = len(x)
    parent, level = np.full(n, -1), np.full(n, 1 << 20)
    distance = np.sqrt(np.maximum(2 * norm - 2 * (x @ x[0]), 0))
    distance[0], nearest = -1, np.zeros(n, int)
    above, current = nearest, 1 << 20
    for _ in range(n - 1):
        i = int(distance.argmax())
        own = math.ceil(math.log2(max(distance[i], 1e-6))) - 1
        if own < current:
            above, current = nearest.copy(), own
        parent[i], level[i] = above[i], own
        to_new = np.sqrt(np.maximum(2 * norm - 2 * (x @ x[i]), 0))
        nearer = to_new < distance
        nearest[nearer] = i
        distance = np.where(nearer, to_new, distance)
        distance[i] = -1
    reach = np.zeros(n)
    groups: dict[tuple[int, int], float] = {}
    points, child = np.arange(n), np.arange(n)
    while len(points := points[parent[child] >= 0]):
        child = child[parent[child] >= 0]
        far = np.sqrt(((x[points] - x[parent[child]]) ** 2).sum(axis=1))
        for key, d in zip(zip(parent[child].tolist(), level[child].tolist()), far.tolist()):
            groups[key] = max(groups.get(key, 0.0), d)
        child = parent[child]
    for i in range(n):
        if parent[i] >= 0:
            reach[i] = groups[int(parent[i]), int(level[i])]
    return parent, level, reach


class CoverTree:
    """A built tree, its points in the order of their groups."""

    def __init__(self, vectors: np.ndarray, parent: np.ndarray, level: np.ndarray, reach: np.ndarray) -> None:
        self.order = np.lexsort((-level, parent))
        place = np.empty(len(parent), int)
        place[self.order] = np.arange(len(parent))
        self.vectors = vectors[self.order]
        self.fast = self.vectors.astype(np.float64)
        self.largest = float(np.abs(self.fast).max(initial=0))
        self.squares = float(_augmented(vectors)[1])
        #: Groups: points of one parent and level, a run of places each.
        owner, step = parent[self.order], level[self.order]
        starts = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (step[1:] != step[:-1]))))
        self.low, self.high = starts, np.append(starts[1:], len(parent))
        group_owner = owner[starts]
        self.owner = np.where(group_owner >= 0, place[group_owner], -1)
        self.radius = reach[self.order][starts]
        self.next = np.full(len(starts), -1)
        self.first = np.full(len(parent), -1)
        for g in range(len(starts) - 1, -1, -1):
            if g + 1 < len(starts) and self.owner[g + 1] == self.owner[g]:
                self.next[g] = g + 1
                self.radius[g] = max(self.radius[g], self.radius[g + 1])
            if self.owner[g] >= 0:
                self.first[self.owner[g]] = g
        self.met = 0

    def search(
        self, query: np.ndarray, windows: list[tuple[float, float]], k: int, counts: np.ndarray, ids: Callable[[int, int], list[int]]
    ) -> list[list[tuple[int, int]]]:
        """For each window of scores the ``k`` best ``(-score, id)``.

        ``counts`` says which places count; ``ids(place, k)`` gives the first ids that a point stands for.
        """
        best: list[list[tuple[int, int]]] = [[] for _ in windows]
        worst = [low for low, _ in windows]
        least, most = np.array(worst, float), np.array([high for _, high in windows], float)
        # the query at the norm of the augmented points; its products are those of ``query`` times this
        own = math.sqrt(float((query.astype(np.float64) ** 2).sum()))
        stretch = math.sqrt(self.squares) / own if own and self.squares else 1.0
        both = 2 * self.squares
        slack = 1e-9 * both / stretch + 1e-6
        fast = self.exact(query)
        rows, asked = (self.fast, query.astype(np.float64)) if fast else (self.vectors, query)
        highest = max(high for _, high in windows)
        queue: list[tuple[float, int, int]] = []

        def meet(low: int, high: int) -> np.ndarray:
            """Scores of the points; the best of those in a window are taken."""
            self.met += high - low
            scores = rows[low:high] @ asked
            any_window = (scores >= min(worst)) & (scores <= highest) & counts[low:high]
            if not any_window.any():
                return scores
            near = np.flatnonzero(any_window)
            near = near[np.argsort(-scores[near], kind="stable")]
            ranked = scores[near].tolist()
            for w, (_, top) in enumerate(windows):
                for place, score in zip(near.tolist(), ranked):
                    if score < worst[w] or len(best[w]) == k and score < -best[w][-1][0]:
                        break
                    if score <= top:
                        score = int(score)
                        best[w] = heapq.nsmallest(k, best[w] + [(-score, i) for i in ids(low + place, k)])
                if len(best[w]) == k:
                    worst[w] = -best[w][-1][0]
                    least[w] = worst[w]
            return scores

        def push(groups: np.ndarray, scores: np.ndarray) -> None:
            """Queue groups whose bounds meet a window. ``scores``: those of the groups' owners."""
            distance = np.sqrt(np.maximum(both - 2 * stretch * scores, 0))
            radius = self.radius[groups] * (1 + 1e-9)
            upper = (both - np.maximum(distance - radius, 0) ** 2) / (2 * stretch) + slack
            lower = (both - (distance + radius) ** 2) / (2 * stretch) - slack
            meets = ((upper[:, None] >= least) & (lower[:, None] <= most)).any(axis=1)
            for u, g, score in zip(upper[meets].tolist(), groups[meets].tolist(), scores[meets].tolist()):
                heapq.heappush(queue, (-u, g, score))

        root = meet(0, 1)
        if self.first[0] >= 0:
            push(self.first[:1], root)
        while queue:
            upper, g, score = heapq.heappop(queue)
            if -upper < least.min():
                break
            low, high = self.low[g], self.high[g]
            scores = meet(low, high)
            groups = self.first[low:high]
            has = groups >= 0
            if self.next[g] >= 0:
                groups, scores = np.append(groups[has], self.next[g]), np.append(scores[has], score)
            else:
                groups, scores = groups[has], scores[has]
            if len(groups):
                push(groups, scores)
        return best

    def exact(self, query: np.ndarray) -> bool:
        """Whether sums of products with ``query`` are exact in double precision."""
        return self.largest * float(np.abs(query).max(initial=0)) * max(len(query), 1) < _EXACT


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), len(flat) // max(len(column), 1))


_TREE = "block long, width int, point int, parent int, level int, reach double, label long, vector array<long>, ids array<long>"


def plant_trees(rows: DataFrame, count: int) -> DataFrame:
    """A row for each distinct label and vector of a block, with its place in the block's tree and the ids it stands for."""
    spread = rows.repartitionByRange(max(1, math.ceil(count / BLOCK_ROWS)), "width", "label", F.xxhash64("vec_id", "vector"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for width, table in _blocks(batches):
            labels, vectors, ids = table["label"].to_numpy(), _vectors(table["vector"]), table["vec_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            keys = np.column_stack((labels, vectors.reshape(len(labels), width)))[order]
            distinct, owner = np.unique(keys, axis=0, return_inverse=True)
            members = np.argsort(owner.ravel(), kind="stable")
            cuts = np.flatnonzero(np.diff(owner.ravel()[members])) + 1
            parent, level, reach = build_tree(distinct[:, 1:])
            n = len(distinct)
            block = TaskContext.get().partitionId() << 32 | made
            made += 1
            flat = pa.array(distinct[:, 1:].ravel(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, block)), pa.array(np.full(n, width), pa.int32()), pa.array(np.arange(n), pa.int32()),
                    pa.array(parent, pa.int32()), pa.array(level, pa.int32()), pa.array(reach), pa.array(distinct[:, 0]),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), flat),
                    pa.ListArray.from_arrays(pa.array([0, *cuts, len(ids)], pa.int32()), pa.array(ids[order][members])),
                ],
                [field.split()[0] for field in _TREE.split(", ")],
            )

    return stage(spread.sortWithinPartitions("width", "label").mapInArrow(build, _TREE), "cover-trees")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows of one width, at most ``BLOCK_ROWS`` at a time."""
    held, width, size = [], None, 0
    for batch in batches:
        widths = batch.column("width").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(widths)) + 1).tolist(), len(widths)]
        for low, high in zip(cuts, cuts[1:]):
            while low < high:
                if held and (widths[low] != width or size == BLOCK_ROWS):
                    yield width, pa.Table.from_batches(held)
                    held, size = [], 0
                width = int(widths[low])
                step = min(high - low, BLOCK_ROWS - size)
                held.append(batch.slice(low, step))
                low, size = low + step, size + step
    if held:
        yield width, pa.Table.from_batches(held)


_FOUND = "anchor_id long, window long, vec_id long, score long"


def _searched(anchors: DataFrame, trees: DataFrame, pairs: DataFrame, k: int, same_label: bool) -> DataFrame:
    """The ``k`` best rows of each block for each window of each anchor; ``windows`` null: one window of all scores."""

    def search(asks: pa.Table, tree: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if asks.num_rows and tree.num_rows:
            tree = tree.sort_by("point")
            columns = [tree[name].to_numpy() for name in ("parent", "level", "reach")]
            built = CoverTree(_vectors(tree["vector"]), *columns)
            labels = tree["label"].to_numpy()[built.order]
            members = tree["ids"].combine_chunks().take(pa.array(built.order))
            ends, flat = members.offsets.to_numpy(), members.values.to_numpy()
            queries = _vectors(asks["vector"])
            for q, (anchor, label, scores) in enumerate(zip(*(asks[name].to_pylist() for name in ("vec_id", "label", "windows")))):
                counts = (labels == label) == same_label
                if not counts.any():
                    continue

                def first_ids(place: int, most: int, anchor=anchor) -> list[int]:
                    own = flat[ends[place] : ends[place + 1]]
                    return own[own != anchor][:most].tolist()

                windows = [(-math.inf, math.inf)] if scores is None else [(w["low"], w["high"]) for w in scores]
                names = [0] if scores is None else [w["of"] for w in scores]
                for name, best in zip(names, built.search(queries[q], windows, k, counts, first_ids)):
                    out += [(anchor, name, i, -score) for score, i in best]
        columns = zip(*out) if out else [[]] * 4
        return pa.table([pa.array(x, pa.int64()) for x in columns], [field.split()[0] for field in _FOUND.split(", ")])

    left = anchors.join(pairs, ["anchor_block", "width"]).select("anchor_block", "block", "vec_id", "label", "vector", "windows")
    right = trees.join(pairs.drop("width"), "block").select("anchor_block", "block", "point", "parent", "level", "reach", "label", "vector", "ids")
    keys = ("anchor_block", "block")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _floor_hundredth(value: Column) -> Column:
    hundred = F.lit(100).cast("long")
    return F.call_function("div", value - F.pmod(value, hundred), hundred)


def mine_hard_negatives(
    vectors: DataFrame, asks: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows for which ``asks`` (on ``vec_id``) is true. A negative's score is ``low`` to ``high`` percent of the
    positive's, both included.
    """
    rows = usable(vectors, scale)
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    facts = rows.agg(F.count("*").alias("n"), F.max(largest * largest * F.col("width")).alias("most")).first()
    if (facts["most"] or 0) * max(low, high, 100) >= 2.0**62:
        raise ValueError("scores of these vectors may not fit 64 bits")
    trees = plant_trees(rows, facts["n"])
    asking = rows.filter(asks & (F.col("vec_id") != _NO_ID)).groupBy("vec_id")
    asking = asking.agg(F.min(F.struct("label", "width", "vector")).alias("row")).select("vec_id", "row.*")
    asking = stage(asking, "anchors")
    places = max(1, math.ceil(asking.count() / ANCHOR_ROWS))
    placed = asking.repartitionByRange(places, "width", "label", F.xxhash64("vec_id"))
    anchors = stage(placed.withColumn("anchor_block", F.spark_partition_id()), "anchors")

    blocks = stage(trees.select("block", "width", "label").distinct(), "blocks")
    asked = stage(anchors.select("anchor_block", "width", "label").distinct(), "blocks")
    near = stage(asked.join(blocks, ["width", "label"]).select("anchor_block", "block", "width").distinct(), "block-pairs")
    alone = anchors.withColumn("windows", F.lit(None).cast("array<struct<of:long,low:long,high:long>>"))
    first = stage(_ranked(_searched(alone, trees, near, positives, True), positives), "positives")

    score = F.col("score")
    # whole bounds, rounded inwards
    least, most = -_floor_hundredth(-score * low), _floor_hundredth(score * high)
    windows = first.select("anchor_id", F.struct(score.alias("of"), least.alias("low"), most.alias("high")).alias("w")).filter("w.low <= w.high")
    windows = windows.groupBy("anchor_id").agg(F.collect_set("w").alias("windows"))
    open_anchors = stage(anchors.join(windows, anchors["vec_id"] == windows["anchor_id"]).drop("anchor_id"), "anchors")
    others = blocks.alias("b").join(asked.alias("a"), (F.col("a.width") == F.col("b.width")) & (F.col("a.label") != F.col("b.label")))
    far = stage(others.select("anchor_block", "block", "a.width").distinct(), "block-pairs")
    found = _ranked(_searched(open_anchors, trees, far, negatives, False), negatives)
    shown = lambda name: F.when(F.col(name) != _NO_ID, F.col(name))
    pairs = first.select("anchor_id", shown("vec_id").alias("positive_id"), F.col("score").alias("window"))
    return pairs.join(found, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), shown("vec_id").alias("negative_id"),
        F.col("window").alias("positive_score"), F.col("score").alias("negative_score"),
    )
