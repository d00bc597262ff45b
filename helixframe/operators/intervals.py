"""Interval joins by position bins. Both sides carry contig, start0, end0 (0-based, half-open)."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.runtime import SALTS, lookup_join, salt_of, stage

#: Bytes up to which the right side of a join is broadcast.
BROADCAST_BYTES = 64 << 20
#: Growth of the bin width from one level to the next.
_LEVEL_FACTOR = 8
READ_KEY = ["read_name", "flag", "contig", "start0", "cigar"]


def _bins(width: int):
    """Bins of ``width`` the row lies in."""
    return F.sequence(F.expr(f"start0 div {width}"), F.expr(f"(end0 - 1) div {width}"))


def _slots(level: int, width: int, side: int, when):
    """Bins of one level the row lies in, where ``when`` holds, as (lane, bin); ``side`` tells whose own level this is."""
    own = F.transform(_bins(width), lambda b: F.struct(F.lit(2 * level + side).alias("lane"), b.alias("bin")))
    return F.when(when, own).otherwise(F.array().cast("array<struct<lane:int,bin:bigint>>"))


@dataclass
class _Size:
    """What is known of one side: rows, bytes, the length of its longest interval and of all together."""
    rows: int
    bytes: int
    longest: int
    total: int


def _size_of(df: DataFrame, with_bytes: bool) -> _Size:
    text = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) + 8 for c in df.columns), F.lit(16)) if with_bytes else F.lit(0)
    r = df.agg(F.count("*").alias("n"), F.sum(text).alias("b"), F.max(F.col("end0") - F.col("start0")).alias("l"),
               F.sum(F.col("end0") - F.col("start0")).alias("t")).first()
    return _Size(r["n"], r["b"] or 0, r["l"] or 0, r["t"] or 0)


def _widths(longest: int, bin_width: int) -> list[int]:
    """Bin widths of the levels: an interval's own level is the first whose bins are as long as it, so it lies in two of them at most."""
    widths = [bin_width]
    while widths[-1] < longest:
        widths.append(widths[-1] * _LEVEL_FACTOR)
    return widths


def overlap_join(left: DataFrame, right: DataFrame, how: str = "inner", *, bin_width: int = 256,
                 key: list[str] | None = None, right_prefix: str = "r_", salts: int = SALTS,
                 broadcast_bytes: int = BROADCAST_BYTES, measured: DataFrame | None = None) -> DataFrame:
    """Rows of ``left`` with the rows of ``right`` they share at least one base with.

    ``how`` is inner, left, left_semi or left_anti. Right columns come back prefixed. A right side that fits ``broadcast_bytes``
    is broadcast, and left rows are not shuffled: inner joins probe its bins, semi and anti joins the union of its intervals, sorted by
    contig. Otherwise both sides are shuffled by bin; the bins that hold a large share of the left rows are counted first, and
    only these are spread over ``salts`` tasks.

    Every interval has a level whose bins are at least as long as it, and a pair meets on the coarser level of its two, so neither a long
    left nor a long right row is in more than two bins of a level. A pair is emitted only in the first bin both share. Rows are
    told apart by themselves, not by ``key``, which is accepted and not needed: equal left rows are joined each on its own.
    An inner join looks at the left rows before it joins them, for their number, lengths and hot bins; ``measured`` are rows that hold
    the intervals of all left rows, others at most, and cost less to read.
    """
    if how == "inner":
        return _pairs(left, right, bin_width, right_prefix, salts, broadcast_bytes, measured)
    if how not in ("left", "left_semi", "left_anti"):
        raise ValueError(f"unknown join type {how!r}")
    spans = right.select("contig", "start0", "end0").where("contig is not null and end0 > start0")
    few = 24 * spans.count() <= broadcast_bytes
    if not few or (how == "left" and _size_of(right.where("contig is not null and end0 > start0"), True).bytes * 4 > broadcast_bytes):
        joined = _by_start(left, right, how, bin_width, right_prefix, salts)
        if joined is not None:
            return joined
    if few:
        hit = _union_probe(spans)
        if how == "left_semi":
            return left.where(hit)
        missed = left.where(~hit)
        if how == "left_anti":
            return missed
        found = _pairs(left, right, bin_width, right_prefix, salts, broadcast_bytes)
    else:
        rows = stage(left.withColumn("_row", F.monotonically_increasing_id()), "left-rows")
        hits = _pairs(rows.select("_row", "contig", "start0", "end0"), spans, bin_width, right_prefix, salts, broadcast_bytes).select("_row").distinct()
        if how != "left":
            return rows.join(hits, "_row", how).drop("_row")
        missed = rows.join(hits, "_row", "left_anti").drop("_row")
        found = _pairs(rows.drop("_row"), right, bin_width, right_prefix, salts, broadcast_bytes)
    nothing = [F.lit(None).cast(f.dataType).alias(right_prefix + f.name) for f in right.schema.fields]
    return found.unionByName(missed.select("*", *nothing))


def _union_probe(spans: DataFrame):
    """Condition: the row overlaps the union of ``spans``, which is broadcast as sorted arrays by contig."""
    table = {}
    for contig, rows in spans.toPandas().groupby("contig"):  # as many bytes as the caller has checked
        rows = rows.sort_values("start0")
        start, reach = rows["start0"].to_numpy(), np.maximum.accumulate(rows["end0"].to_numpy())
        first = np.concatenate([[True], start[1:] > reach[:-1]])  # where a new disjoint stretch begins
        last = np.concatenate([first[1:], [True]])
        table[contig] = (start[first], reach[last])
    shared = spans.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def overlaps(contig: pd.Series, start0: pd.Series, end0: pd.Series) -> pd.Series:
        out, start, end = np.zeros(len(contig), dtype=bool), start0.to_numpy(), end0.to_numpy()
        for name, rows in contig.groupby(contig).indices.items():
            if name in shared.value:
                starts, ends = shared.value[name]
                at = np.searchsorted(ends, start[rows], side="right")  # the first stretch that ends behind the row's start
                out[rows] = (at < len(ends)) & (starts[np.minimum(at, len(ends) - 1)] < end[rows]) & (end[rows] > start[rows])
        return pd.Series(out)

    return overlaps("contig", "start0", "end0")


def _pairs(left: DataFrame, right: DataFrame, bin_width: int, prefix: str, salts: int, broadcast_bytes: int,
           measured: DataFrame | None = None) -> DataFrame:
    left = left.where("contig is not null and end0 > start0")
    right = right.where("contig is not null and end0 > start0")
    seen = left if measured is None else measured.where("contig is not null and end0 > start0").select("contig", "start0", "end0")
    mine, theirs = _size_of(seen, False), _size_of(right, True)
    widths = _widths(max(mine.longest, theirs.longest), bin_width)
    top_left, top_right = len(_widths(mine.longest, bin_width)) - 1, len(_widths(theirs.longest, bin_width)) - 1
    span = F.col("end0") - F.col("start0")
    level = F.lit(len(widths) - 1)
    for k in range(len(widths) - 2, -1, -1):
        level = F.when(span <= widths[k], F.lit(k)).otherwise(level)
    # on side 0 the left row is at its own level and the right row there or finer; on side 1 the right row is, and the left one is finer
    lanes = [_slots(k, widths[k], 0, level == k) for k in range(top_left + 1)] + [_slots(k, widths[k], 1, level < k) for k in range(1, top_right + 1)]
    binned_left = left.withColumn("_slot", F.explode(F.concat(*lanes)))
    lanes = [_slots(k, widths[k], 0, level <= k) for k in range(top_left + 1)] + [_slots(k, widths[k], 1, level == k) for k in range(1, top_right + 1)]
    binned_right = right.withColumn("_slot", F.explode(F.concat(*lanes))).select(
        F.col("contig").alias("_c"), F.col("_slot").alias("_s"), *[F.col(c).alias(prefix + c) for c in right.columns])
    width = F.get(F.array(*[F.lit(w).cast("bigint") for w in widths]), F.shiftright("_slot.lane", 1))
    meets = ((F.col("contig") == F.col("_c")) & (F.col("_slot") == F.col("_s"))
             & (F.col("start0") < F.col(f"{prefix}end0")) & (F.col(f"{prefix}start0") < F.col("end0"))
             & (F.col("_slot.bin") == F.floor(F.greatest("start0", f"{prefix}start0") / width)))
    if theirs.bytes * 2 * (top_left + 2) <= broadcast_bytes:
        joined = binned_left.join(F.broadcast(binned_right), meets)
    else:
        joined = _by_start(left, right, "inner", bin_width, prefix, salts, (mine, theirs), seen)
        if joined is None:
            joined = _spread(binned_left, binned_right, mine.rows, salts, hashable_columns(left), meets)
    return joined.select(*left.columns, *[prefix + c for c in right.columns])


def _by_start(left: DataFrame, right: DataFrame, how: str, bin_width: int, prefix: str, salts: int,
              sizes: tuple[_Size, _Size] | None = None, seen: DataFrame | None = None) -> DataFrame | None:
    """The join with every left row in one bin only, that of its start, and right rows in all bins where a left row that meets them can start.

    So every join type is one shuffle of the left rows as they are; rows without a place are dealt out and meet nothing. Hot bins are spread
    over ``salts`` tasks. None where long right rows would lie in too many bins: more than four a level on average and than there are left rows.
    """
    placed = "contig is not null and end0 > start0"
    mine, theirs = sizes or (_size_of(left.where(placed), False), _size_of(right.where(placed), False))
    widths, span = _widths(mine.longest, bin_width), F.col("end0") - F.col("start0")
    if sum(theirs.total // w + 2 * theirs.rows for w in widths) > max(4 * len(widths) * theirs.rows, mine.rows):
        return None

    def bin_of(at, width):
        return F.floor((at - F.pmod(at, F.lit(width).cast("bigint"))) / width)

    first = F.col("start0").cast("bigint")
    level, at = F.lit(len(widths) - 1), bin_of(first, widths[-1])
    for k in range(len(widths) - 2, -1, -1):
        level, at = F.when(span <= widths[k], F.lit(k)).otherwise(level), F.when(span <= widths[k], bin_of(first, widths[k])).otherwise(at)
    spread = [c for c in READ_KEY if c in left.columns] if set(READ_KEY) <= set(left.columns) else hashable_columns(left)
    lane = F.when(F.expr(placed), level).otherwise(F.lit(-1))
    near = left.withColumn("_lane", lane).withColumn("_bin", F.when(F.expr(placed), at).otherwise(salt_of(spread, 4096).cast("bigint")))

    def reached(k, w):
        bins = F.sequence(bin_of(first - (w - 1), w), bin_of(F.col("end0").cast("bigint") - 1, w))
        return F.transform(bins, lambda b: F.struct(F.lit(k).alias("lane"), b.alias("bin")))

    reach = [reached(k, w) for k, w in enumerate(widths)]
    far = right.where(placed).withColumn("_s", F.explode(F.concat(*reach))).select(
        F.col("contig").alias("_c"), F.col("_s.lane").alias("_l"), F.col("_s.bin").alias("_b"), *[F.col(c).alias(prefix + c) for c in right.columns])
    binned = (left if seen is None else seen).where(placed).select("contig", lane.alias("_lane"), at.alias("_bin"))
    hot = (binned.groupBy("contig", "_lane", "_bin").count().where(F.col("count") > max(1, mine.rows // 500))
           .select(F.col("contig").alias("_hc"), F.col("_lane").alias("_hl"), F.col("_bin").alias("_hb"), F.lit(True).alias("_hot")))
    hot = F.broadcast(stage(hot, "hot-bins"))  # 500 rows at most
    of_near = (F.col("contig") == F.col("_hc")) & (F.col("_lane") == F.col("_hl")) & (F.col("_bin") == F.col("_hb"))
    of_far = (F.col("_c") == F.col("_hc")) & (F.col("_l") == F.col("_hl")) & (F.col("_b") == F.col("_hb"))
    copies = F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    near = near.join(hot, of_near, "left").withColumn("_salt", F.when(F.col("_hot"), salt_of(spread, salts)).otherwise(F.lit(0))).drop("_hc", "_hl", "_hb", "_hot")
    far = far.join(hot, of_far, "left").withColumn("_copy", copies).drop("_hc", "_hl", "_hb", "_hot")
    meets = ((F.col("contig") == F.col("_c")) & (F.col("_lane") == F.col("_l")) & (F.col("_bin") == F.col("_b")) & (F.col("_salt") == F.col("_copy"))
             & (F.col("start0") < F.col(f"{prefix}end0")) & (F.col(f"{prefix}start0") < F.col("end0")))
    joined = near.join(far.hint("merge"), meets, how)
    return joined.select(*left.columns, *([prefix + c for c in right.columns] if how in ("inner", "left") else []))


def _spread(left: DataFrame, right: DataFrame, rows: int, salts: int, spread: list[str], meets) -> DataFrame:
    """The join with the few slots that hold more than a five-hundredth of the left rows spread over ``salts`` tasks each."""
    hot = (left.groupBy("contig", "_slot").count().where(F.col("count") > max(1, rows // 500))
           .select(F.col("contig").alias("_hc"), F.col("_slot").alias("_hs"), F.lit(True).alias("_hot")))
    hot = F.broadcast(stage(hot, "hot-slots"))  # 500 rows for each lane and bin a row can lie in, at most
    salt = F.when(F.col("_hot"), salt_of(spread, salts)).otherwise(F.lit(0))
    copies = F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    near = left.join(hot, (F.col("contig") == F.col("_hc")) & (F.col("_slot") == F.col("_hs")), "left").withColumn("_salt", salt).drop("_hc", "_hs", "_hot")
    far = right.join(hot, (F.col("_c") == F.col("_hc")) & (F.col("_s") == F.col("_hs")), "left").withColumn("_copy", copies).drop("_hc", "_hs", "_hot")
    return near.join(far, meets & (F.col("_salt") == F.col("_copy")))


def hashable_columns(df: DataFrame) -> list[str]:
    """Columns whose hash spreads rows evenly: everything but maps, which cannot be hashed."""
    return [f.name for f in df.schema.fields if f.dataType.typeName() != "map"]


def overlap_bases():
    """Bases shared by a left row and its r_ partner, as a Column."""
    return F.least("end0", "r_end0") - F.greatest("start0", "r_start0")


def merge_intervals(intervals: DataFrame, window: int = 1 << 20) -> DataFrame:
    """Union of overlapping or touching intervals as contig, start0, end0."""
    steps = stage(depth_steps(intervals), "depth-steps")
    depth = running_total(steps, "delta", window).withColumn("before", F.col("total") - F.col("delta"))
    borders = stage(depth.where("(before = 0) <> (total = 0)").select("contig", "pos0", "total"), "borders")
    return (next_position(borders, borders, window).where("total > 0")
            .select("contig", F.col("pos0").alias("start0"), F.col("next0").alias("end0")))


def depth_steps(intervals: DataFrame) -> DataFrame:
    """contig, pos0, delta: change of depth at each position where it changes."""
    ends = F.explode(F.array(F.struct(F.col("start0").alias("pos0"), F.lit(1).alias("d")),
                             F.struct(F.col("end0").alias("pos0"), F.lit(-1).alias("d"))))
    return (intervals.where("contig is not null and end0 > start0").select("contig", ends.alias("e"))
            .groupBy("contig", F.col("e.pos0").alias("pos0")).agg(F.sum("e.d").alias("delta")).where("delta <> 0"))


def _stretches(df: DataFrame, window: int) -> DataFrame:
    return df.withColumn("_stretch", F.expr(f"pos0 div {window}"))


def running_total(steps: DataFrame, value: str, window: int = 1 << 20) -> DataFrame:
    """Adds ``total``: sum of ``value`` up to and including each position of its contig.

    Sums run inside stretches of ``window`` bases; the totals of earlier stretches, one row per stretch,
    are added from a small table, so no task ever sees a whole contig. ``steps`` is read twice.
    """
    cut = _stretches(steps, window)
    inside = W.partitionBy("contig", "_stretch").orderBy("pos0").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("contig").orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = (cut.groupBy("contig", "_stretch").agg(F.sum(value).alias("_sum"))
               .select("contig", "_stretch", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carry")))
    joined = lookup_join(cut.withColumn("total", F.sum(value).over(inside)), carried, ["contig", "_stretch"],
                         "left", ["pos0"])
    return joined.withColumn("total", F.col("total") + F.col("_carry")).drop("_stretch", "_carry")


def next_position(rows: DataFrame, positions: DataFrame, window: int = 1 << 20) -> DataFrame:
    """Adds ``next0``: position of the following row of the contig, found stretch by stretch.

    ``positions`` has the same contig and pos0 as ``rows`` but is cheap to read.
    """
    inside = W.partitionBy("contig", "_stretch").orderBy("pos0")
    after = W.partitionBy("contig").orderBy("_stretch")
    first = (_stretches(positions, window).groupBy("contig", "_stretch").agg(F.min("pos0").alias("_first"))
             .select("contig", "_stretch", F.lead("_first").over(after).alias("_next_first")))
    joined = lookup_join(_stretches(rows, window).withColumn("next0", F.lead("pos0").over(inside)), first,
                         ["contig", "_stretch"], "left", ["pos0"])
    return joined.withColumn("next0", F.coalesce("next0", "_next_first")).drop("_stretch", "_next_first")
