"""What to do with malformed records of the text sources."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

MODES = ("STRICT", "LENIENT", "SILENT")
#: Reports of LENIENT reads by name: ``dropped`` is known once an action has run.
REPORTS: dict[str, Observation] = {}


def stringency(df: DataFrame, mode: str, malformed: Column, record: str, label: str = "records") -> DataFrame:
    """STRICT fails at the first malformed record, LENIENT drops and counts them, SILENT drops them."""
    if mode not in MODES:
        raise ValueError(f"stringency is one of {MODES}")
    bad = F.coalesce(malformed, F.lit(True))
    if mode == "STRICT":
        # The error is raised while the record column itself is computed, so no projection can skip it.
        checked = F.when(bad, F.raise_error(F.concat(F.lit(f"malformed {label}: "), F.substring(F.col(record).cast("string"), 1, 200)))
                         .cast("string")).otherwise(F.col(record))
        # The condition reads the checked column, so that counting rows computes it too; it holds for every row that is left.
        return df.withColumn(record, checked).where(F.coalesce(F.length(F.col(record).cast("string")), F.lit(0)) >= 0)
    if mode == "LENIENT":
        seen = Observation()
        REPORTS[label] = seen
        df = df.observe(seen, F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).alias("dropped"))
    return df.where(~bad)
