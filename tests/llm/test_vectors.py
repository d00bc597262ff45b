"""Clustering and hard negatives against brute force, with nulls, ties, repeats, other lengths and hot groups."""
import collections
import hashlib
import math
import random

import numpy as np
import pytest

from helixframe.llm import centroids, negatives

SCHEMA = "vec_id long, embedding array<float>, label int, uid long, v string, cluster string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, "v", "c") for r in rows], SCHEMA).repartition(parts)


def vectors(n, dims, seed=3, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, dims)], int(rng.integers(0, 4))) for i in range(n)]
    rows += [(n + k, rows[5][1], rows[5][2]) for k in range(copies)]
    return rows


ODD = [(1000, None, 1), (1001, [], 1), (1002, [0.5] * 3, 1), (1003, [0.1] * 7 + [None], 1), (1004, [float("nan")] + [0.1] * 7, 1),
       (1005, [float("inf")] + [0.1] * 7, 2)]


def lloyd(rows, k, rounds, dims):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, _ in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [list(v) for _, v in order[:k]]
    near = lambda v: min(range(len(c)), key=lambda j: (sum((a - b) ** 2 for a, b in zip(v, c[j])), j))
    for _ in range(rounds):
        of = collections.defaultdict(list)
        for _, v in kept:
            of[near(v)].append(v)
        for j, members in of.items():
            c[j] = [sum(col) // len(members) for col in zip(*members)]
    out = [(i, j := near(v), sum((a - b) ** 2 for a, b in zip(v, c[j]))) for i, v in kept]
    sums = collections.Counter()
    for _, j, d in out:
        sums[j] += d
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return collections.Counter((i, j, d, sums[j], sum(sums.values()), sha[j]) for i, j, d in out)


@pytest.mark.parametrize("dims, n, copies", [(8, 120, 90), (37, 60, 0), (8, 5, 0)])
def test_clusters_like_plain_lloyd(spark, dims, n, copies, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK_BYTES", 2048)  # many blocks
    rows = vectors(n, dims, copies=copies if n > 5 else 0)
    rows += [rows[2], rows[2], (None, rows[3][1], 0), (None, rows[4][1], None)] + ODD
    found = centroids.cluster_vectors(table(spark, rows), k=6, rounds=3, dims=dims)
    assert collections.Counter(map(tuple, found.collect())) == lloyd(rows, 6, 3, dims)


def test_no_vectors(spark):
    assert centroids.cluster_vectors(table(spark, ODD), dims=8).count() == 0
    assert centroids.cluster_vectors(spark.createDataFrame([], SCHEMA)).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster_vectors(table(spark, [(1, [1e9] * 8, 1)]), dims=8).collect()


def mined(rows, every):
    kept = []
    for i, v, label in rows:
        if label is None or v is None or not all(x is not None and math.isfinite(x) for x in v):
            continue
        kept.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    rank = lambda r: (-r[1], r[0] is None, r[0] or 0)
    for a, (i, label, v) in enumerate(kept):
        if i is None or i % every:
            continue
        scores = [(j, sum(x * y for x, y in zip(v, w)), other == label) for b, (j, other, w) in enumerate(kept) if b != a]
        for j, score, _ in sorted((s for s in scores if s[2]), key=rank)[:5]:
            fit = sorted((s for s in scores if not s[2] and 30 * score <= 100 * s[1] <= 90 * score), key=rank)[:10]
            out += [(i, j, r, s[0], score, s[1]) for r, s in enumerate(fit, 1)]
    return collections.Counter(out)


@pytest.mark.parametrize("block, chunk", [(4, 16), (512, 4096)])
def test_negatives_like_brute_force(spark, block, chunk, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "CHUNK", chunk)
    rng = random.Random(2)
    rows = vectors(160, 8, copies=60)
    rows = [(i, [x + (0.3 if k == label else 0) for k, x in enumerate(v)], label) for i, v, label in rows]
    rows += [rows[20], rows[20], rows[33], (None, rows[40][1], 2), (300, [0.0] * 8, 1), (310, [0.2, 0.1], 3), (320, rows[7][1], None)] + ODD
    rng.shuffle(rows)
    found = negatives.mine_negatives(table(spark, rows), every=10).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    expected = mined(rows, 10)
    assert collections.Counter(map(tuple, found.collect())) == expected and len(expected) > 500


def test_no_anchors(spark):
    assert negatives.mine_negatives(table(spark, [(1, [0.1], 1), (2, [0.2], 2)])).count() == 0
    assert negatives.mine_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert negatives.mine_negatives(table(spark, [(100, [0.1], 1)])).count() == 0


def test_tree_bounds_prune_and_hold():
    rng = np.random.default_rng(1)
    centre = rng.integers(-200, 200, (5, 16))
    points = np.concatenate([c + rng.integers(-3, 4, (30, 16)) for c in centre]).astype(np.int32)
    order, parent, edge = negatives.spanning_tree(points)
    tree = points[order].astype(np.int64)
    assert sorted(order) == list(range(150)) and all(p < k for k, p in enumerate(parent) if k)
    length = np.sqrt(((tree - tree[parent]) ** 2).sum(axis=1))
    assert np.all(edge >= length) and np.allclose(edge, length)

    class Part:
        levels = negatives._Part.levels

    a, c = Part(), Part()
    a.data, a.parent, a.edge = tree.astype(np.int32), parent, edge
    c.data = np.concatenate([points, rng.integers(-200, 200, (50, 16))]).astype(np.int32)
    truth, least, scored, kept = tree @ c.data.T.astype(np.int64), 250_000, 0, np.zeros((150, 200), dtype=bool)

    def wanted(level, low, high):
        assert np.all(low <= truth[level]) and np.all(high >= truth[level])
        return high >= least

    for k, at, scores in negatives.bounded_scores(a, c, wanted):
        assert np.array_equal(scores, truth[k, at])
        kept[k, at] = True
        scored += len(at)
    assert np.array_equal(kept & (truth >= least), truth >= least) and scored < 0.6 * truth.size
