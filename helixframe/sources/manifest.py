"""Cohorts named by a manifest: one path per line."""
from __future__ import annotations

import posixpath
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.sources.sam import scan_columnar_reads, scan_sam

#: Schemes the documentation allows for a local and for a cluster run.
LOCAL_SCHEMES = ("file", "http", "ftp")
CLUSTER_SCHEMES = ("s3a", "http", "ftp")
#: Lines of a manifest; it names files and is read on the driver.
_MAX_PATHS = 100_000


def manifest_paths(spark: SparkSession, manifest: str, allowed_schemes=LOCAL_SCHEMES) -> list[str]:
    """Stripped, non-blank lines, each with an allowed scheme."""
    rows = spark.read.text(manifest).where(F.trim("value") != "").limit(_MAX_PATHS + 1).collect()
    if len(rows) > _MAX_PATHS:
        raise ValueError(f"more than {_MAX_PATHS} paths in {manifest}")
    paths = [r.value.strip() for r in rows]
    wrong = [p for p in paths if urlparse(p).scheme not in allowed_schemes]
    if wrong:
        raise ValueError(f"paths need one of the schemes {tuple(allowed_schemes)}: {wrong[:5]}")
    return paths


def sample_of(path: str) -> str:
    return posixpath.basename(urlparse(path).path.rstrip("/")).split(".")[0]


def scan_manifest(spark: SparkSession, manifest: str, allowed_schemes=LOCAL_SCHEMES, mode: str = "STRICT") -> DataFrame:
    """All files of the manifest as one cohort; the sample is the file name up to its first dot."""
    paths = manifest_paths(spark, manifest, allowed_schemes)
    names = [sample_of(p) for p in paths]
    if len(set(names)) != len(names):
        raise ValueError("two paths of the manifest name the same sample")
    text = [p for p in paths if p.endswith((".sam", ".sam.gz"))]
    columnar = [p for p in paths if not p.endswith((".sam", ".sam.gz"))]
    parts = []
    if text:
        parts.append(scan_sam(spark, text, mode, sample_by_file=True))
    for p in columnar:
        parts.append(scan_columnar_reads(spark, p).withColumn("sample", F.lit(sample_of(p))))
    merged = parts[0]
    for other in parts[1:]:
        merged = merged.unionByName(other, allowMissingColumns=True)
    return merged

