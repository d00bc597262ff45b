"""Shared-folder staging and size-checked joins used by the operators."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a lookup table is broadcast; beyond it the join is salted and shuffled.
BROADCAST_ROWS = 200_000
#: Copies made of the smaller side of a salted join, i.e. tasks a single hot key is spread over.
SALTS = 16
#: Setting under which the shuffle files of a query are removed when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else a temporary one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    active = context.getCheckpointDir()
    if active:
        return active.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="helixframe-")
    context.setCheckpointDir(path)
    return shared_dir(spark)


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Used where two branches must see the same rows (partition numbers, sampled ranges) or where an
    expensive intermediate is read more than once. Lost executors do not lose it. Once the table is written,
    the shuffle files behind it are no longer needed and go, so that a chain of stages does not pile them up.
    """
    spark = session_of(df)
    path = scratch_path(spark, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the table that ``stage`` wrote and ``df`` reads, once no plan will read it again."""
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(name)
        if not shared_dir(df.sparkSession).removeprefix("file:").lstrip("/") in name:
            raise ValueError(f"{name} is no staged table")
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; reads no further than the limit."""
    return df.limit(max_rows + 1).count() <= max_rows


def salt_of(columns: list[str], salts: int = SALTS):
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(salts)).cast("int")


def replicate(df: DataFrame, salts: int = SALTS, name: str = "_salt") -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str, spread: list[str],
                salts: int = SALTS) -> DataFrame:
    """Equi-join whose hot left keys are spread over ``salts`` tasks by a hash of ``spread``.

    The copied side is never broadcast: Spark takes its size from the files behind it, which the copies do not change.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted join does not support {how!r}")
    salted = left.withColumn("_salt", salt_of(spread, salts))
    return salted.join(replicate(right, salts).hint("merge"), on + ["_salt"], how).drop("_salt")


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left",
                spread: list[str] | None = None, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a table expected to be small: broadcast when it is, salted shuffle join when not."""
    if fits(right, max_rows):
        return left.join(F.broadcast(right), on, how)
    return salted_join(left, right, on, how, spread or left.columns[:1])


def sized_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a table that grows with the data and has a few rows for each key: broadcast while it is small, else both sides are sorted.

    Nothing is copied beyond that, so that what is shuffled grows as the tables do; adaptive execution splits the left rows of a hot key.
    """
    return left.join(F.broadcast(right) if fits(right, max_rows) else right.hint("merge"), on, how)


def bounded_values(df: DataFrame, column: str, max_rows: int = 100_000) -> list:
    """Distinct values of a dimension-like column (samples, contigs); refuses unbounded ones."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{column} has more than {max_rows} values; it is not a dimension")
    return sorted(r[0] for r in rows)
