"""Centroid clustering: Lloyd's rounds over vectors that are sharded by dimension.

Vectors are cut into blocks of rows, and each block into column slices; a slice is one row of a table. A task that holds a slice
computes exact partial squared distances to the same columns of all centroids. Partial distances of one block are added
by the block's key, and the sum gives each vector its centroid. Then every shard of columns sums its own slices by centroid and replaces its
own columns of the centroids; no task needs whole vectors or whole centroids. All arithmetic is on integers, so that
results depend neither on the order of rows nor on the shards.

The driver holds the centroids (``k`` times the dimension) and nothing else. A block's partial distances are bounded by ``BLOCK_BYTES``.

Edge cases: rows whose vector is null, of another length, or has a null or non-finite component take no part; a null vec_id is hashed
as no text; of rows with equal vec_id the smaller vector is first among the starts, and repeated rows count each on its own; with fewer than
``k`` vectors every vector is a start; equal distances go to the smaller centroid; an empty table gives an empty result;
other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.vectors import integers, matrix_of, products, squares, usable
from helixframe.runtime import stage

#: Columns of a shard; bytes of the partial distances, or of the vectors, of one block at most.
SHARD = 16
BLOCK_BYTES = 1 << 20


def _packed(vectors: DataFrame, dims: int, k: int) -> DataFrame:
    """block, shard, data: int32 columns of a block of rows; and with shard -1 the vec_ids of the block."""
    rows_of_block = max(1, BLOCK_BYTES // (8 * max(k, dims)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, lists = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(ids), rows_of_block):
                part = lists.slice(at, rows_of_block)
                whole = part.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int32)
                out = [(block, -1, None, ids[at:at + rows_of_block])]
                out += [(block, s, whole[:, c:c + SHARD].tobytes(), None) for s, c in enumerate(range(0, dims, SHARD))]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate(
                    (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64())))], ["block", "shard", "data", "ids"])
                block += 1

    return vectors.select("vec_id", "v").mapInArrow(pack, "block long, shard int, data binary, ids array<long>")


def _starts(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hashes."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in first], dtype=np.int64)


def _nearest(slices: DataFrame, centroids: np.ndarray) -> DataFrame:
    """block, cluster (int32 by row), distance (int64 by row)."""
    k = len(centroids)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, shard, data in zip(batch["block"], batch["shard"], batch["data"]):
                own = centroids[:, shard * SHARD:(shard + 1) * SHARD]
                x = np.frombuffer(data, dtype=np.int32).reshape(-1, own.shape[1])
                d = squares(x)[:, None] + squares(own)[None, :] - 2 * products(x, own)
                yield pd.DataFrame({"block": [block], "partial": [d.tobytes()]})

    def added(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:  # one row for each shard
        total = sum(np.frombuffer(p, dtype=np.int64) for p in rows["partial"]).reshape(-1, k)
        cluster = total.argmin(axis=1)  # the first of equal ones
        return pd.DataFrame({"block": [key[0]], "cluster": [cluster.astype(np.int32).tobytes()], "distance": [total.min(axis=1).tobytes()]})

    return slices.mapInPandas(partial, "block long, partial binary").groupBy("block").applyInPandas(
        added, "block long, cluster binary, distance binary")


def _moved(slices: DataFrame, nearest: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after each shard has replaced its own columns by floor(sum / count) of its slices."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, data, cluster in zip(batch["shard"], batch["data"], batch["cluster"]):
                width = min(SHARD, dims - shard * SHARD)
                x = np.frombuffer(data, dtype=np.int32).reshape(-1, width)
                at = np.frombuffer(cluster, dtype=np.int32)
                own = total.setdefault(shard, np.zeros((k, width + 1), dtype=np.int64))
                np.add.at(own[:, :width], at, x)
                own[:, width] += np.bincount(at, minlength=k)
        for shard, own in total.items():
            c, j = np.nonzero(own[:, -1:] * np.ones(own.shape[1] - 1, dtype=np.int64))
            yield pd.DataFrame({"cluster": c, "dim": shard * SHARD + j, "s": own[c, j], "n": own[c, -1]})

    cells = (slices.join(nearest.select("block", "cluster"), "block").select("shard", "data", "cluster")
             .mapInPandas(sums, "cluster int, dim int, s long, n long").groupBy("cluster", "dim").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
             .select("cluster", "dim", F.expr("(s - pmod(s, n)) div n").alias("x")))
    out = centroids.copy()
    for r in cells.collect():  # k times the dimension at most
        out[r["cluster"], r["dim"]] = r["x"]
    return out


def cluster_vectors(rows: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 for every vector of ``rows`` (vec_id, embedding)."""
    spark = rows.sparkSession
    vectors = rows.where(F.size("embedding") == dims).where(usable()).select(F.col("vec_id").cast("long").alias("vec_id"), integers(scale).alias("v"))
    centroids = _starts(vectors, k, seed)
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], out)
    packed = stage(_packed(vectors, dims, k), "vector-slices")
    slices, ids = packed.where("shard >= 0").select("block", "shard", "data"), packed.where("shard < 0").select("block", "ids")
    for _ in range(rounds):
        centroids = _moved(slices, stage(_nearest(slices, centroids), "nearest"), centroids)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, cluster, distance in zip(*(batch.column(j).to_pylist() for j in range(3))):
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(np.frombuffer(cluster, dtype=np.int32)),
                                                  pa.array(np.frombuffer(distance, dtype=np.int64))], ["vec_id", "cluster", "distance"])

    final = stage(ids.join(_nearest(slices, centroids), "block").select("ids", "cluster", "distance").mapInArrow(
        rows_of, "vec_id long, cluster int, distance long"), "clusters")
    sums = {r["cluster"]: r["s"] for r in final.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    facts = [(c, s, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, s in sums.items()]
    table = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return final.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
