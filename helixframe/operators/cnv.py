"""Copy number calling from target depths: filter, normalise, score, segment."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.runtime import lookup_join, stage

_REGION = ["target", "contig", "start0", "end0"]
#: Samples of a cohort: their square matrix of doubles has to fit the driver.
MAX_SAMPLES = 8192


def cnv_filter_matrix(coverage: DataFrame, *, min_target_length: int = 10, max_target_length: int = 10_000,
                      min_target_depth: float = 10, max_target_depth: float = 500, min_sample_depth: float = 25,
                      max_sample_depth: float = 200, max_sample_sd: float = 150) -> DataFrame:
    """Drop targets by length and mean depth, then samples by mean and spread; centre targets in ``value``."""
    by_target = W.partitionBy(*_REGION)  # names may be absent, or shared by the exons of a gene
    length = F.col("end0") - F.col("start0")
    targets = (coverage.where(length.between(min_target_length, max_target_length))
               .withColumn("_mean", F.avg("mean_depth").over(by_target))
               .where(F.col("_mean").between(min_target_depth, max_target_depth)).drop("_mean"))
    samples = (targets.groupBy("sample").agg(F.avg("mean_depth").alias("m"), F.stddev_samp("mean_depth").alias("s"))
               .where(F.col("m").between(min_sample_depth, max_sample_depth)
                      & (F.coalesce("s", F.lit(0.0)) <= max_sample_sd)).select("sample"))
    kept = lookup_join(targets, samples, ["sample"], "left_semi", ["target"])
    return kept.withColumn("value", F.col("mean_depth") - F.avg("mean_depth").over(by_target))


#: Rounding error of the removal, relative to the values it starts from.
_ROUNDING = 1e-9


def cnv_pca_normalise(matrix: DataFrame, factor: float = 0.7, value: str = "value") -> DataFrame:
    """Subtract the principal components whose variance exceeds ``factor`` times the mean variance.

    Rows are targets and columns samples; only the samples-by-samples matrix reaches the driver. What is left of a target
    counts as zero where it is within rounding error (``_ROUNDING`` of the target's largest value): were all components removed, the
    rest would be noise that depends on the order of rows.
    """
    wide = stage(matrix.groupBy(*_REGION).agg(F.array_sort(F.collect_list(F.struct("sample", F.col(value).alias("v"))))
                                              .alias("cells")), "depth-matrix")
    sizes = wide.agg(F.min(F.size("cells")), F.max(F.size("cells"))).first()
    if not sizes[1]:
        return matrix.select("sample", *_REGION, F.col(value).alias("value"))
    if sizes[0] != sizes[1]:
        raise ValueError("every target needs a value for every sample")
    if sizes[1] > MAX_SAMPLES:
        raise ValueError(f"more than {MAX_SAMPLES} samples")
    vectors = MLUtils.convertVectorColumnsFromML(wide.select(array_to_vector("cells.v").alias("row")), "row")
    svd = RowMatrix(vectors).computeSVD(sizes[1], computeU=False, rCond=1e-9)
    singular = svd.s.toArray()
    variance = singular ** 2
    removed = variance > factor * variance.sum() / sizes[1]
    axes = wide.sparkSession.sparkContext.broadcast(svd.V.toArray()[:, removed])

    @F.pandas_udf("array<double>")
    def subtract(rows: pd.Series) -> pd.Series:
        if rows.empty:
            return rows
        x = np.stack(rows.to_list())
        left = x - (x @ axes.value) @ axes.value.T
        return pd.Series(list(np.where(np.abs(left) <= _ROUNDING * np.abs(x).max(axis=1, keepdims=True), 0.0, left)))

    clean = wide.withColumn("clean", subtract("cells.v"))
    return clean.select(*_REGION, F.explode(F.arrays_zip(F.col("cells.sample").alias("sample"), F.col("clean"))).alias("z")).select(
        F.col("z.sample").alias("sample"), *_REGION, F.col("z.clean").alias("value"))


def cnv_zscore(matrix: DataFrame, max_sd: float = 30, value: str = "value") -> DataFrame:
    """Drop targets that vary too much between samples, then standardise each sample into ``z``."""
    steady = (matrix.withColumn("_sd", F.coalesce(F.stddev_samp(value).over(W.partitionBy(*_REGION)), F.lit(0.0)))
              .where(F.col("_sd") <= max_sd).drop("_sd"))
    stats = steady.groupBy("sample").agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    return (lookup_join(steady, stats, ["sample"], "left", ["target"])
            .withColumn("z", F.when(F.col("_s") > 0, (F.col(value) - F.col("_m")) / F.col("_s")).otherwise(F.lit(0.0)))
            .drop("_m", "_s"))


_STATES = ("DEL", "DIP", "DUP")


def _log_transitions(distance: np.ndarray, p: float, n: float, scale: float) -> np.ndarray:
    """(T, 3, 3) log transition probabilities; row = from, column = to."""
    f = np.exp(-distance / scale)
    q = 1.0 / n
    t = np.empty((len(distance), 3, 3))
    t[:, 1] = np.array([p, 1 - 2 * p, p])
    stay, back, cross = f * (1 - q) + (1 - f) * p, f * q + (1 - f) * (1 - 2 * p), (1 - f) * p
    t[:, 0] = np.stack([stay, back, cross], axis=1)
    t[:, 2] = np.stack([cross, back, stay], axis=1)
    with np.errstate(divide="ignore"):
        return np.log(t)


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def segment_states(z: np.ndarray, start0: np.ndarray, end0: np.ndarray, p: float, n: float, scale: float,
                   shift: float = 3.0) -> list[tuple[int, int, int, int]]:
    """Viterbi segments other than DIP as (first, last, state, quality)."""
    size = len(z)
    emit = -0.5 * (z[:, None] - np.array([-shift, 0.0, shift])) ** 2
    gap = np.maximum(start0[1:] - end0[:-1], 0)
    trans = _log_transitions(gap.astype(float), p, n, scale)
    prior = np.log([p, 1 - 2 * p, p])
    best, forward = np.empty((size, 3)), np.empty((size, 3))
    came = np.zeros((size, 3), dtype=int)
    best[0] = forward[0] = prior + emit[0]
    for t in range(1, size):
        step = best[t - 1][:, None] + trans[t - 1]
        came[t] = step.argmax(axis=0)
        best[t] = step.max(axis=0) + emit[t]
        forward[t] = _log_sum(forward[t - 1][:, None] + trans[t - 1], 0) + emit[t]
    backward = np.zeros((size, 3))
    for t in range(size - 2, -1, -1):
        backward[t] = _log_sum(trans[t] + emit[t + 1] + backward[t + 1], 1)
    total = _log_sum(forward[-1], 0)
    state = np.empty(size, dtype=int)
    state[-1] = best[-1].argmax()
    for t in range(size - 1, 0, -1):
        state[t - 1] = came[t, state[t]]
    found, t = [], 0
    while t < size:
        last = t
        while last + 1 < size and state[last + 1] == state[t]:
            last += 1
        if state[t] != 1:
            k = state[t]
            inside = sum(trans[i - 1, k, k] + emit[i, k] for i in range(t + 1, last + 1))
            log_p = min(float(forward[t, k] + inside + backward[last, k] - total), 0.0)
            miss = max(-np.expm1(log_p), 1e-10)
            found.append((t, last, int(k), int(min(99, np.floor(-10 * np.log10(miss) + 0.5)))))
        t = last + 1
    return found


def cnv_discover(scores: DataFrame, p: float = 1e-8, n: float = 6, scale: float = 70e3) -> DataFrame:
    """DEL and DUP calls per sample: contig, start0, end0, type, sample, targets, quality.

    A three-state hidden Markov model runs along the targets of one sample on one contig. Its group is
    bounded by the number of targets on a contig, whatever the number of reads or samples.
    """
    def call(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start0", "end0"], kind="stable")
        starts, ends = pdf["start0"].to_numpy(), pdf["end0"].to_numpy()
        rows = [(key[1], int(starts[a]), int(ends[a:b + 1].max()), _STATES[k], key[0], b - a + 1, quality)
                for a, b, k, quality in segment_states(pdf["z"].to_numpy(float), starts, ends, p, n, scale)]
        return pd.DataFrame(rows, columns=["contig", "start0", "end0", "type", "sample", "targets", "quality"])

    return (scores.select("sample", "contig", "start0", "end0", "z").groupBy("sample", "contig")
            .applyInPandas(call, "contig string, start0 bigint, end0 bigint, type string, sample string, "
                                 "targets int, quality int"))


def cnvs_as_features(cnvs: DataFrame) -> DataFrame:
    text = F.col("targets").cast("string")
    return cnvs.select("contig", "start0", "end0", F.concat_ws("_", "sample", "type", "contig", "start0").alias("name"),
                       F.col("quality").cast("double").alias("score"), F.lit(".").alias("strand"),
                       F.lit("cnv").alias("source"), "type",
                       F.create_map(F.lit("sample"), F.col("sample"), F.lit("targets"), text).alias("attributes"))
