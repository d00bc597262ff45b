"""Aggregates over reads, reference blocks and regions."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import aligned_blocks, has_all, has_none
from helixframe.operators.intervals import (depth_steps, next_position, overlap_bases, overlap_join, running_total)
from helixframe.runtime import bounded_values, stage


def mean_insert_size(reads: DataFrame, max_len: int = 10_000, default: int = 150) -> DataFrame:
    """Floor of the mean |tlen| over first mates of proper pairs; ``default`` when there is none."""
    size = F.abs("tlen")
    return (reads.where(has_all(66) & (size < max_len))
            .agg(F.coalesce(F.floor(F.avg(size)), F.lit(default)).cast("bigint").alias("mean_insert_size")))


def sequence_dictionary(ref_blocks: DataFrame) -> DataFrame:
    """contig, length, md5 of the upper-case sequence.

    A digest is sequential by nature: the blocks of a contig stream in order through one task, which
    holds one Arrow batch at a time and never the contig.
    """
    ordered = ref_blocks.select("contig", "block", F.upper("seq").alias("seq")).repartition("contig")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, length, md5 = None, 0, hashlib.md5()
        for batch in batches:
            for contig, rows in batch.groupby("contig", sort=False):
                if contig != name:
                    if name is not None:
                        yield pd.DataFrame([(name, length, md5.hexdigest())], columns=["contig", "length", "md5"])
                    name, length, md5 = contig, 0, hashlib.md5()
                text = "".join(rows["seq"])
                length += len(text)
                md5.update(text.encode())
        if name is not None:
            yield pd.DataFrame([(name, length, md5.hexdigest())], columns=["contig", "length", "md5"])

    return (ordered.sortWithinPartitions("contig", "block")
            .mapInPandas(digest, "contig string, length bigint, md5 string"))


def sam_bin(start="start0", end="end0"):
    """Bin number of the hierarchical binning scheme of the SAM format."""
    e = f"({end} - 1)"
    # Fixed values of the format: shift and first bin of each level.
    levels = [(14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)]
    branches = " ".join(f"WHEN shiftright({start}, {s}) = shiftright({e}, {s}) THEN {o} + shiftright({start}, {s})"
                        for s, o in levels)
    return F.expr(f"CASE {branches} ELSE 0 END")


def bins_of_region(start0: int, end0: int) -> list[int]:
    last = end0 - 1
    found = [0]
    for shift, first in [(26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)]:
        found.extend(range(first + (start0 >> shift), first + (last >> shift) + 1))
    return found


def genomic_bin_index(reads: DataFrame) -> DataFrame:
    """Reads per contig, format bin and 16 kb window, with the first start in each."""
    return (reads.where(has_none(0x4))
            .groupBy("contig", sam_bin().cast("bigint").alias("bin"),
                     F.shiftright("start0", 14).cast("bigint").alias("window"))
            .agg(F.count("*").alias("n_reads"), F.min("start0").alias("min_start0")))


def with_bins(reads: DataFrame) -> DataFrame:
    """Reads with their format bin stored, laid out so that a region touches few files."""
    return (reads.withColumn("bin", sam_bin().cast("bigint"))
            .repartitionByRange("contig", "start0").sortWithinPartitions("contig", "start0"))


def region_lookup(reads: DataFrame, contig: str, start0: int, end0: int) -> DataFrame:
    """Reads overlapping a region; with a stored ``bin`` column the bin list reaches the scan."""
    exact = reads.where((F.col("contig") == contig) & (F.col("start0") < end0) & (F.col("end0") > start0))
    bins = bins_of_region(start0, end0)
    if "bin" in reads.columns and len(bins) <= 1000:
        return exact.where(F.col("bin").isin(bins))
    return exact


def target_coverage(reads: DataFrame, targets: DataFrame, samples: list[str] | None = None,
                    exclude: int = 0xF04) -> DataFrame:
    """sample, target, contig, start0, end0, bases, mean_depth for every sample and target, zeros included."""
    usable = reads.where(has_none(exclude)).select("sample", "contig", "start0", "end0", "read_name", "flag")
    regions = targets.select("contig", "start0", "end0", F.col("name").alias("name"))
    names = samples if samples is not None else bounded_values(reads, "sample")
    covered = (overlap_join(usable, regions).select(
        "sample", F.col("r_name").alias("target"), F.col("r_contig").alias("contig"),
        F.col("r_start0").alias("start0"), F.col("r_end0").alias("end0"), overlap_bases().alias("bases")))
    empty = regions.select(F.explode(F.array(*[F.lit(s) for s in names])).alias("sample"), F.col("name").alias("target"),
                           "contig", "start0", "end0", F.lit(0).cast("bigint").alias("bases"))
    return (covered.unionByName(empty).groupBy("sample", "target", "contig", "start0", "end0")
            .agg(F.sum("bases").alias("bases"))
            .withColumn("mean_depth", F.col("bases") / (F.col("end0") - F.col("start0"))))


def coverage_signal(reads: DataFrame, window: int = 1 << 20) -> DataFrame:
    """Runs of constant depth over aligned blocks: contig, start0, end0, depth (depth > 0)."""
    blocks = (reads.where(has_none(0x4))
              .select("contig", F.explode(aligned_blocks("cigar", "start0")).alias("b"))
              .select("contig", F.col("b.ref_start").alias("start0"),
                      (F.col("b.ref_start") + F.col("b.len")).alias("end0")))
    steps = stage(depth_steps(blocks), "depth-steps")
    depth = running_total(steps, "delta", window)
    return (next_position(depth, steps, window).where("total > 0")
            .select("contig", F.col("pos0").alias("start0"), F.col("next0").alias("end0"),
                    F.col("total").alias("depth")))


def alignment_summary(alignments: DataFrame, max_loci: int = 20) -> DataFrame:
    """One row: reads by number of loci, mean length, splices, and mismatch rate when ``nm`` is there."""
    locus = F.when(has_none(0x804), 1).otherwise(0)
    primary = has_none(0x900)
    nm = F.col("nm") if "nm" in alignments.columns else F.lit(None).cast("bigint")
    per_read = (alignments.groupBy("read_name", F.col("flag").bitwiseAND(0xC0).alias("mate"))
                .agg(F.sum(locus).alias("loci"),
                     F.max(F.when(primary, F.length("sequence"))).alias("length"),
                     F.sum(F.when(primary, F.length("cigar") - F.length(F.replace("cigar", F.lit("N"), F.lit("")))))
                     .alias("splices"),
                     F.sum(F.when(primary & has_none(0x4), nm)).alias("nm"),
                     F.sum(F.when(primary & has_none(0x4), F.length("sequence"))).alias("mapped_bases")))

    def number(condition):
        return F.coalesce(F.sum(F.when(condition, 1)), F.lit(0)).cast("bigint")

    loci = F.col("loci")
    return per_read.agg(
        F.count("*").alias("input_reads"), number(loci == 1).alias("unique_reads"),
        number((loci > 1) & (loci <= max_loci)).alias("multi_reads"),
        number(loci > max_loci).alias("too_many_loci"), number(loci == 0).alias("unmapped_reads"),
        F.avg("length").alias("mean_length"), F.coalesce(F.sum("splices"), F.lit(0)).alias("splices"),
        (F.sum("nm") / F.sum("mapped_bases")).alias("mismatch_rate"))
