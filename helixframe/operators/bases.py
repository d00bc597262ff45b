"""Reads against the reference: gap-free pieces, each inside one reference block."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import aligned_blocks
from helixframe.runtime import sized_join

#: Reference text broadcast at most; a longer reference is shuffled.
_BROADCAST_BYTES = 64 << 20
BLOCK_WIDTH = 1024


def reference_windows(ref_blocks: DataFrame) -> DataFrame:
    """Each block together with the next one, for what starts in a block and may run on."""
    following = ref_blocks.select("contig", (F.col("block") - 1).alias("block"), F.col("seq").alias("_next"))
    return (ref_blocks.join(following, ["contig", "block"], "left")
            .select("contig", "block", F.concat("seq", F.coalesce("_next", F.lit(""))).alias("window"),
                    F.length("seq").alias("block_len")))


def mask_reference(ref_blocks: DataFrame, sites: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """Reference with every base inside a known site replaced by N.

    Masking the reference instead of the reads keeps the sites out of the per-base rows altogether.
    """
    places = (sites.where("end0 > start0").select("contig", F.explode(F.sequence("start0", F.col("end0") - 1)).alias("pos0"))
              .select("contig", F.expr(f"pos0 div {width}").alias("block"), (F.col("pos0") % width).cast("int").alias("at"))
              .groupBy("contig", "block").agg(F.collect_set("at").alias("_at")))
    masked = F.array_join(F.transform(F.split("seq", ""), lambda c, i: F.when(
        F.array_contains("_at", i), F.lit("N")).otherwise(c)), "")
    return (ref_blocks.join(places, ["contig", "block"], "left")
            .select("contig", "block", F.when(F.col("_at").isNull(), F.col("seq")).otherwise(masked).alias("seq")))


def cut_at_blocks(runs: DataFrame, keep: list[str], width: int) -> DataFrame:
    """Split rows with ref_start, read_start, len where they cross into the next reference block."""
    cut = runs.withColumn("block", F.explode(F.expr(f"sequence(ref_start div {width}, (ref_start + len - 1) div {width})")))
    skip = F.greatest(F.col("block") * width - F.col("ref_start"), F.lit(0))
    end = F.least(F.col("ref_start") + F.col("len"), (F.col("block") + 1) * width)
    return cut.select(*keep, "block", (F.col("ref_start") + skip).alias("ref_start"),
                      (F.col("read_start") + skip).cast("int").alias("read_start"),
                      (end - F.col("ref_start") - skip).cast("int").alias("len"))


def aligned_pieces(reads: DataFrame, keep: list[str], width: int) -> DataFrame:
    """One row per gap-free aligned run and block: block, ref_start, read_start, len."""
    runs = reads.select(*dict.fromkeys(keep + ["cigar", "start0"])).select(
        *keep, F.explode(aligned_blocks("cigar", "start0")).alias("_b")).select(*keep, "_b.*")
    return cut_at_blocks(runs.where("len > 0"), keep, width)


def with_reference(pieces: DataFrame, ref_blocks: DataFrame, width: int) -> DataFrame:
    """Adds ``ref``: the reference bases under each piece. Pieces outside the reference are dropped."""
    named = ref_blocks.select("contig", "block", F.col("seq").alias("_block_seq"))
    joined = sized_join(pieces, named, ["contig", "block"], max_rows=max(1, _BROADCAST_BYTES // width))
    offset = (F.col("ref_start") - F.col("block") * width + 1).cast("int")
    return joined.withColumn("ref", F.col("_block_seq").substr(offset, F.col("len"))).drop("_block_seq")


def base_rows(pieces: DataFrame, keep: list[str]) -> DataFrame:
    """One row per aligned base with its reference base: pos0, at (index in the read), base, quality, ref_base.

    Meant to be aggregated at once: the rows are produced inside the task and never shuffled as they are.
    """
    each = pieces.withColumn("_k", F.explode(F.sequence(F.lit(0), F.least(F.col("len"), F.length("ref")) - 1)))
    at = F.col("read_start") + F.col("_k")
    return each.where("_k >= 0").select(
        *keep, (F.col("ref_start") + F.col("_k")).alias("pos0"), at.alias("at"),
        F.col("sequence").substr(at + 1, F.lit(1)).alias("base"),
        (F.ascii(F.col("qualities").substr(at + 1, F.lit(1))) - 33).alias("quality"),
        F.col("ref").substr(F.col("_k") + 1, F.lit(1)).alias("ref_base"))
