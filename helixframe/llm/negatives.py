"""Hard-negative mining with bounds along a spanning tree of the anchors.

Anchors are packed into blocks of at most ``BLOCK`` and tied together by a minimum spanning tree of their Euclidean distances.
A candidate's score (inner product) at a child anchor differs from that at its parent by at most the length of the edge times
the norm of the candidate. So scores are computed at the root, and carried down the tree level by level as intervals; a
candidate is scored anew at an anchor only where its interval overlaps the window of scores that can still matter there, and its
interval is then exact. Nothing outside a window is lost, since an interval always holds the true score.

Candidates are packed into chunks of at most ``CHUNK`` rows. Both sides are sorted by label first, so that the search for positives
only meets blocks and chunks with a label in common; the search for negatives meets every block with every chunk, as an anchor's
window can hold rows from anywhere. A meeting is one key (block, chunk), hence one bounded group of one task, whatever the
sizes of labels. Of each meeting only the best few per anchor go on.

Edge cases: rows with a null label, a null vector, or a null or non-finite component take no part; shorter vectors count as
filled up with zeros; a row without vec_id is no anchor and comes after all others of its score; repeated rows are
rows of their own, so a copy of an anchor with its label is one of its positives; a positive that no row fits to gives no
rows; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.llm.vectors import integers, matrix_of, products, squares, usable
from helixframe.runtime import salted_join, stage

#: Anchors of a block, candidates of a chunk.
BLOCK = 512
CHUNK = 4096
#: Stands for a missing vec_id in the order of ties.
_LAST = np.iinfo(np.int64).max
_PACK = "part long, labels array<long>, uid binary, vec_id binary, label binary, data binary, width int"


def _packed(rows: DataFrame, bound: int, tree: bool) -> DataFrame:
    """Rows of (uid, vec_id, label, v) packed in the order of their labels; with ``tree`` also parent and edge of each row."""
    def flush(part: int, held: list[tuple]):
        held.sort(key=lambda r: r[2])
        uid, vec_id, label, v = zip(*held)
        width = max(map(len, v))
        data = matrix_of(v, width)
        out = [part, sorted(set(label)), np.array(uid, dtype=np.int64), np.array([_LAST if x is None else x for x in vec_id], dtype=np.int64),
               np.array(label, dtype=np.int64), data, width]
        if tree:
            order, parent, edge = spanning_tree(data)
            out = out[:2] + [x[order] for x in out[2:6]] + [width, parent, edge]
        return [x.tobytes() if isinstance(x, np.ndarray) else x for x in out]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId() << 32, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                if len(held) == bound:
                    yield _batch(flush(part, held), tree)
                    part, held = part + 1, []
        if held:
            yield _batch(flush(part, held), tree)

    parts = 1 + rows.count() * 5 // (4 * bound)  # most partitions then fill one part
    ordered = rows.select("uid", "vec_id", "label", "v").repartitionByRange(parts, "label", F.xxhash64("uid")).sortWithinPartitions("label")
    return ordered.mapInArrow(pack, _PACK + (", parent binary, edge binary" if tree else ""))


def _batch(row: list, tree: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4, pa.int32()] + [pa.binary()] * (2 * tree)
    names = [x.split()[0] for x in _PACK.split(", ")] + ["parent", "edge"]
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names[:len(kinds)])


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree by Prim's method: an order that puts parents first, and by it parent (place) and edge length.

    Rows of one depth stand together. Lengths are rounded up. The root is its own parent.
    """
    n, norms = len(points), squares(points)
    near, by = np.full(n, _LAST, dtype=np.int64), np.zeros(n, dtype=np.int64)
    depth, parent, square, inside, last = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool), 0
    inside[0] = True
    for _ in range(n - 1):
        d = norms + norms[last] - 2 * products(points, points[last:last + 1])[:, 0]
        closer = ~inside & (d < near)
        near[closer], by[closer] = d[closer], last
        last = int(np.where(inside, _LAST, near).argmin())
        inside[last], parent[last], square[last], depth[last] = True, by[last], near[last], depth[by[last]] + 1
    order = np.argsort(depth, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    return order, place[parent[order]], np.sqrt(square[order].astype(np.float64)) * (1 + 1e-9)


class _Part:
    """One packed block or chunk."""

    def __init__(self, row, side: str):
        get = lambda name, kind: np.frombuffer(row[f"{side}_{name}"], dtype=kind)
        self.uid, self.vec_id, self.label = (get(x, np.int64) for x in ("uid", "vec_id", "label"))
        self.data = get("data", np.int32).reshape(len(self.uid), -1)
        if side == "a":
            self.parent, self.edge = get("parent", np.int64), get("edge", np.float64)

    def levels(self) -> list[np.ndarray]:
        """Places of the anchors by depth."""
        depth = np.zeros(len(self.parent), dtype=np.int64)
        for k in range(1, len(depth)):
            depth[k] = depth[self.parent[k]] + 1
        return [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)]


def bounded_scores(anchors: _Part, candidates: _Part, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, candidates, their exact scores) down the tree, for the candidates that ``wanted`` leaves.

    ``wanted(anchors, low, high)`` says by anchor and candidate which intervals overlap what matters there.
    """
    a, c = anchors.data, candidates.data
    width = max(a.shape[1], c.shape[1])
    a, c = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, c))
    norm = np.sqrt(squares(c).astype(np.float64)) * (1 + 1e-9)
    low, high = np.empty((len(a), len(c))), np.empty((len(a), len(c)))
    for depth, level in enumerate(anchors.levels()):
        if depth == 0:
            exact = products(a[level], c)
            low[level], high[level] = exact, exact
        else:
            above, below = low[anchors.parent[level]], high[anchors.parent[level]]
            reach = anchors.edge[level][:, None] * norm[None, :] + 1 + 1e-9 * np.maximum(np.abs(above), np.abs(below))
            low[level], high[level] = above - reach, below + reach
        want = wanted(level, low[level], high[level])
        rows, columns = np.flatnonzero(want.any(axis=1)), np.flatnonzero(want.any(axis=0))
        exact = products(a[level[rows]], c[columns])
        for k, row in enumerate(rows):
            mine = want[row, columns]
            at = columns[mine]
            low[level[row], at] = high[level[row], at] = exact[k, mine]
            yield int(level[row]), at, exact[k, mine]


def _least_of_best(low: np.ndarray, sure: np.ndarray, k: int) -> np.ndarray:
    """By row, a score that ``k`` of the ``sure`` columns reach; minus infinity where there are fewer of them."""
    if low.shape[1] < k:
        return np.full(len(low), -np.inf)
    return np.partition(np.where(sure, low, -np.inf), low.shape[1] - k, axis=1)[:, low.shape[1] - k]


def _first(k: int, scores: np.ndarray, at: np.ndarray, part: _Part) -> np.ndarray:
    """Indexes of the ``k`` best: higher scores, then smaller vec_id, then the row."""
    if len(scores) > 4 * k:  # drop what is surely behind
        keep = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return keep[_first(k, scores[keep], at[keep], part)] if len(keep) < len(scores) else np.lexsort((part.uid[at], part.vec_id[at], -scores))[:k]
    return np.lexsort((part.uid[at], part.vec_id[at], -scores))[:k]


def _positives(k: int):
    def search(_, rows: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(chunk):
            anchors, candidates = _Part(rows.iloc[0], "a"), _Part(chunk.iloc[0], "c")

            def wanted(level, low, high):
                other = (anchors.label[level][:, None] == candidates.label[None, :]) & (anchors.uid[level][:, None] != candidates.uid[None, :])
                return other & (high >= _least_of_best(low, other, k)[:, None])

            for a, at, scores in bounded_scores(anchors, candidates, wanted):
                out += [(rows["part"].iloc[0], anchors.uid[a], anchors.vec_id[a], candidates.uid[at[j]], candidates.vec_id[at[j]], scores[j])
                        for j in _first(k, scores, at, candidates)]
        return _frame(out, "part anchor_uid anchor_id positive_uid positive_id positive_score")

    return search


def _frame(rows: list[tuple], names: str) -> pd.DataFrame:
    return pd.DataFrame(np.array(rows, dtype=np.int64).reshape(-1, len(names.split())), columns=names.split())


def _negatives(k: int, low_percent: int, high_percent: int):
    def search(_, rows: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(chunk):
            anchors, candidates = _Part(rows.iloc[0], "a"), _Part(chunk.iloc[0], "c")
            place = {u: i for i, u in enumerate(anchors.uid.tolist())}
            own: dict[int, list[tuple[int, int, int]]] = {}
            for p in rows["positives"].iloc[0]:
                own.setdefault(place[p["anchor_uid"]], []).append((p["positive_uid"], p["positive_id"], p["positive_score"]))

            def wanted(level, low, high):
                other = anchors.label[level][:, None] != candidates.label[None, :]
                want = np.zeros(other.shape, dtype=bool)
                for i, a in enumerate(level.tolist()):
                    for _, _, score in own.get(a, ()):  # scores from `least` to `most` matter
                        least, most = low_percent * score / 100 - 1e-6 * abs(score), high_percent * score / 100 + 1e-6 * abs(score)
                        mine = other[i] & (low[i] <= most) & (high[i] >= least)
                        sure = mine & (low[i] >= low_percent * score / 100 + 1e-6 * abs(score)) & (high[i] <= high_percent * score / 100 - 1e-6 * abs(score))
                        want[i] |= mine & (high[i] >= _least_of_best(low[i][None], sure[None], k)[0])
                return want

            for a, at, scores in bounded_scores(anchors, candidates, wanted):
                different = candidates.label[at] != anchors.label[a]
                for uid, vec_id, score in own.get(a, ()):
                    mine = np.flatnonzero(different & (low_percent * score <= 100 * scores) & (100 * scores <= high_percent * score))
                    out += [(anchors.uid[a], anchors.vec_id[a], uid, vec_id, score, candidates.uid[at[mine[j]]], candidates.vec_id[at[mine[j]]], scores[mine[j]])
                            for j in _first(k, scores[mine], at[mine], candidates)]
        return _frame(out, "anchor_uid anchor_id positive_uid positive_id positive_score negative_uid negative_id negative_score")

    return search


def _meet(pairs: DataFrame, blocks: DataFrame, chunks: DataFrame, search, schema: str) -> DataFrame:
    """``search`` over every pair (block, chunk): each pair is a group of one packed block and one packed chunk."""
    left = salted_join(pairs, blocks.withColumnRenamed("part", "block"), ["block"], "inner", ["chunk"]).withColumn("part", F.col("block"))
    right = pairs.join(chunks.withColumnRenamed("part", "chunk"), "chunk").withColumnsRenamed({"block": "of_block", "chunk": "own"})
    return left.groupBy("block", "chunk").cogroup(right.groupBy("of_block", "own")).applyInPandas(search, schema)


def _best(rows: DataFrame, keys: list[str], score: str, vec_id: str, uid: str, k: int) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc(score), vec_id, uid)
    return rows.withColumn("rank", F.row_number().over(order)).where(f"rank <= {k}")


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low_percent: int = 30, high_percent: int = 90) -> DataFrame:
    """For each anchor and each of its first ``positives``: the first ``negatives`` rows of another label in the window of scores.

    ``rows`` and ``anchors`` hold uid (one number a row, the same in both), vec_id, label and v (integers). A negative's score
    lies from ``low_percent`` to ``high_percent`` of the positive's. Gives anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score, and the uids of the three rows.
    """
    sided = lambda df, side: df.select("part", *[F.col(c).alias(f"{side}_{c}") for c in df.columns if c != "part"])
    blocks, chunks = stage(sided(_packed(anchors, BLOCK, True), "a"), "anchor-blocks"), stage(sided(_packed(rows, CHUNK, False), "c"), "candidate-chunks")
    block_labels = blocks.select(F.col("part").alias("block"), F.explode("a_labels").alias("label"))
    chunk_labels = chunks.select(F.col("part").alias("chunk"), F.explode("c_labels").alias("label"))
    same = salted_join(chunk_labels, block_labels, ["label"], "inner", ["chunk"]).select("block", "chunk").distinct()
    found = _meet(stage(same, "label-pairs"), blocks, chunks, _positives(positives),
                  "part long, anchor_uid long, anchor_id long, positive_uid long, positive_id long, positive_score long")
    found = stage(_best(found, ["part", "anchor_uid"], "positive_score", "positive_id", "positive_uid", positives), "positives")
    of_block = found.groupBy("part").agg(F.collect_list(F.struct("anchor_uid", "positive_uid", "positive_id", "positive_score")).alias("positives"))
    blocks = stage(blocks.join(of_block, "part"), "anchor-blocks")  # at most BLOCK times ``positives`` entries a block
    # every block of anchors meets all rows, chunk by chunk; a number that names no block finds none in the join
    most = blocks.agg(F.max(F.shiftright("part", 32)).alias("p"), F.max(F.col("part").bitwiseAND((1 << 32) - 1)).alias("i")).first()
    each = (most["i"] or 0) + 1
    grid = chunks.select(F.col("part").alias("chunk"), F.explode(F.expr(f"sequence(0L, {((most['p'] or 0) + 1) * each - 1}L)")).alias("at")) \
                 .select("chunk", F.expr(f"shiftleft(at div {each}, 32) + at % {each}").alias("block"))
    met = _meet(grid, blocks, chunks, _negatives(negatives, low_percent, high_percent),
                "anchor_uid long, anchor_id long, positive_uid long, positive_id long, positive_score long, negative_uid long, negative_id long, negative_score long")
    best = _best(met, ["anchor_uid", "positive_uid"], "negative_score", "negative_id", "negative_uid", negatives)
    named_id = lambda c: F.when(F.col(c) < _LAST, F.col(c)).alias(c)
    return best.select("anchor_id", named_id("positive_id"), "rank", named_id("negative_id"), "positive_score", "negative_score",
                       "anchor_uid", "positive_uid", "negative_uid")


def mine_negatives(table: DataFrame, scale: int = 256, every: int = 100, moved: int = 7, labels: int = 10) -> DataFrame:
    """``hard_negatives`` of an embeddings table (vec_id, embedding, label), with the rows whose vec_id ``every`` divides as anchors.

    Where ``moved`` divides vec_id, the label first becomes (label + 1) % ``labels``.
    """
    label = F.when(F.col("vec_id") % moved == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    rows = stage(table.where(F.col("label").isNotNull() & usable()).select(
        F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        integers(scale).alias("v")), "integer-vectors")
    return hard_negatives(rows, rows.where(F.col("vec_id") % every == 0))
