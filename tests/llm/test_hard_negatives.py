import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import hard_negatives
from recordloom.llm.hard_negatives import CoverTree, build_tree, mine_hard_negatives
from tests.llm.edges import with_clashes

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every=5, positives=5, negatives=3):
    kept = []
    for i, e, label in rows:
        if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, label, [math.floor(256 * x) for x in e]))
    out = []
    anchors = {}
    for i, label, e in kept:
        if i is not None and i % every == 0:
            anchors[i] = min(anchors.get(i, (label, e)), (label, e))
    by = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for a, (own, q) in anchors.items():
        scored = [(sum(x * y for x, y in zip(q, e)), i, label) for i, label, e in kept if i != a and len(e) == len(q)]
        for ps, p, _ in sorted([x for x in scored if x[2] == own], key=by)[:positives]:
            fit = [x for x in scored if x[2] != own and 50 * ps <= 100 * x[0] <= 95 * ps]
            out += [(a, p, k, n, ps, ns) for k, (ns, n, _) in enumerate(sorted(fit, key=by)[:negatives], 1)]
    return sorted(out, key=repr)


def run(spark, rows, every=5, clashes=False):
    frame = spark.createDataFrame(rows, SCHEMA)
    found = mine_hard_negatives(with_clashes(frame) if clashes else frame, F.col("vec_id") % every == 0)
    return sorted(map(tuple, found.collect()), key=repr)


def clustered(seed, n, width=6, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels * 2, width))
    rows = []
    for i in range(n):
        c = rng.integers(len(centres))
        vector = centres[c] + rng.normal(size=width) * rng.choice([0.02, 0.4])
        rows.append((i, [float(x) for x in vector / (np.linalg.norm(vector) if i % 3 else 1)], int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_over_many_blocks(spark, seed, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 37)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 11)
    rows = clustered(seed, 400)
    assert run(spark, rows) == plain(rows)


def test_nulls_repeats_ties_and_widths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.5, 0.1], 2), (5, [0.9, 0.1], 1), (None, [0.8, 0.1], 1), (None, [0.7, 0.1], 2),
        (6, [0.8, 0.1], 1), (7, [0.8, 0.1], 1), (7, [0.8, 0.1], 1), (8, [0.6, 0.0], 2), (9, [0.6, 0.0], 2), (9, [0.6, 0.0], 3), (11, [0.6, 0.0], 2),
        (10, [1.0], 1), (12, [0.9], 1), (13, [0.8], 2), (14, None, 1), (15, [1.0, None], 1), (16, [nan, 1.0], 1), (17, [inf, 1.0], 2),
        (20, [-1.0, 0.0], 1), (21, [1.0, 0.0], 2), (25, [0.0, 0.0], 1), (26, [0.0, 1.0], 1), (30, [1.0, 1.0], None), (35, [], 1), (36, [], 1), (37, [], 2),
    ]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows, clashes=True) == plain(rows)
    assert len(plain(rows)) > 20


def test_one_vector_on_a_third_of_the_rows(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 25)
    rows = clustered(3, 150) + [(200 + i, [0.5, 0.5, 0.1, 0.0, 0.2, 0.0], i % 3) for i in range(75)]
    assert run(spark, rows) == plain(rows)


def test_empty_lone_and_refused(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, [1.0], 1)]) == []
    with pytest.raises(ValueError):
        run(spark, [(5, [1e30], 1)])
    large = [(i, [float(3e5 * math.cos(i)), float(3e5 * math.sin(i))], i % 2) for i in range(40)]
    assert run(spark, large) == plain(large)


def test_tree_invariants_and_skipped_points():
    rng = np.random.default_rng(7)
    x = np.unique(np.concatenate([rng.integers(-20, 20, (200, 5)), 3000 + rng.integers(-20, 20, (200, 5))]), axis=0)
    parent, level, reach = build_tree(x)
    y, _ = hard_negatives._augmented(x)
    far = lambda i, j: float(np.sqrt(((y[i] - y[j]) ** 2).sum()))
    below = {i: {i} for i in range(len(x))}
    for i in range(len(x)):
        j, own = i, level[i]
        while parent[j] >= 0:
            below[parent[j]].add(i)
            assert far(i, parent[j]) <= reach[j] * (1 + 1e-9) + 1e-9
            j = parent[j]
        if parent[i] >= 0:
            assert far(i, parent[i]) <= 2.0 ** (own + 1) + 1e-6 and level[parent[i]] > own
    assert len(below[0]) == len(x)
    for step in sorted(set(level[parent >= 0].tolist())):
        net = np.flatnonzero(level >= step)
        gaps = [far(i, j) for i in net[:60] for j in net[:60] if i < j]
        assert min(gaps, default=math.inf) > 2.0**step - 1e-6
    tree = CoverTree(x, parent, level, reach)
    query = np.array([1, 1, 1, 1, 1])
    scores = x @ query
    limit = int(scores.max() // 2)
    every = np.ones(len(x), bool)
    found = tree.search(query, [(-math.inf, math.inf), (limit // 2, limit)], 3, every, lambda place, k: [int(tree.order[place])])
    want = [sorted((-int(s), i) for i, s in enumerate(scores) if low <= s <= high)[:3] for low, high in [(-math.inf, math.inf), (limit // 2, limit)]]
    assert found == want
    assert tree.met < 0.7 * len(x)
