"""Row filters and projections over reads and alignments."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from helixframe.functions import (aligned_length, cigar_ops, has_all, has_none, introns, reverse_complement,
                                  sam_flag_is)
from helixframe.operators.intervals import READ_KEY
from helixframe.runtime import lookup_join, stage

_MATE_BITS = 0xC0
#: Annotated junctions of a genome: a few hundred thousand narrow rows.
_JUNCTION_ROWS = 1_000_000


def mate_bits():
    return F.col("flag").bitwiseAND(_MATE_BITS)


def aligned_reads(reads: DataFrame) -> DataFrame:
    """Mapped reads. Uses the stored ``mapped`` column when there is one, since that reaches the scan."""
    return reads.where("mapped") if "mapped" in reads.columns else reads.where(has_none(0x4))


def limit_projection(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns)


def flag_filter(reads: DataFrame, require: int = 0, exclude: int = 0) -> DataFrame:
    return reads.where(has_all(require) & has_none(exclude))


def multimap_filter(alignments: DataFrame, max_loci: int = 20) -> DataFrame:
    """Drop every row of a read that maps to more than ``max_loci`` places."""
    locus = F.when(has_none(0x804), 1).otherwise(0)
    loci = F.sum(locus).over(W.partitionBy("read_name", mate_bits()))
    return alignments.withColumn("_loci", loci).where(F.col("_loci") <= max_loci).drop("_loci")


def mismatch_filter(alignments: DataFrame, max_mismatches: int = 999, fraction: float = 0.04,
                    group: tuple[str, ...] = ("read_name",)) -> DataFrame:
    """Keep rows whose ``nm``, summed over the mates of a pair, is within both limits."""
    both = W.partitionBy(*group)
    return (alignments.withColumn("_nm", F.sum("nm").over(both))
            .withColumn("_len", F.sum(F.length("sequence")).over(both))
            .where((F.col("_nm") <= max_mismatches) & (F.col("_nm") <= F.col("_len") * fraction))
            .drop("_nm", "_len"))


def intron_mate_filter(alignments: DataFrame, intron_min: int = 20, intron_max: int = 1_000_000,
                       mate_gap_max: int = 1_000_000) -> DataFrame:
    """Keep rows whose N gaps lie within the limits and whose mate starts within ``mate_gap_max``."""
    gaps_ok = F.forall(cigar_ops("cigar"), lambda o: (o["op"] != "N") | o["len"].between(intron_min, intron_max))
    gap = F.abs(F.col("mate_start0") - F.col("start0"))
    near = F.coalesce((F.col("mate_contig") != F.col("contig")) | (gap <= mate_gap_max), F.lit(True))
    return alignments.where(gaps_ok & near)


def _spliced(alignments: DataFrame):
    has_gap = F.instr("cigar", "N") > 0
    return alignments.where(has_gap), alignments.where(~has_gap | F.col("cigar").isNull())


def _read_introns(spliced: DataFrame) -> DataFrame:
    return (spliced.select(*READ_KEY, F.explode(introns("cigar", "start0")).alias("j"))
            .select(*READ_KEY, F.col("j.start0").alias("j_start0"), F.col("j.end0").alias("j_end0"),
                    F.least("j.left", "j.right").alias("overhang")))


def overhang_filter(alignments: DataFrame, annotated: DataFrame, novel_min: int = 8,
                    annotated_min: int = 1) -> DataFrame:
    """Keep rows with enough aligned bases beside each junction. Unspliced rows pass without a shuffle."""
    spliced, plain = _spliced(alignments)
    known = (annotated.select("contig", F.col("start0").alias("j_start0"), F.col("end0").alias("j_end0"))
             .distinct().withColumn("known", F.lit(True)))
    looked_up = lookup_join(_read_introns(spliced), known, ["contig", "j_start0", "j_end0"], "left", ["read_name"],
                            _JUNCTION_ROWS)
    short = looked_up.where(F.col("overhang") < F.when(F.col("known"), annotated_min).otherwise(novel_min))
    return plain.unionByName(spliced.join(short.select(*READ_KEY), READ_KEY, "left_anti"))


def by_junction_filter(alignments: DataFrame, passing: DataFrame) -> DataFrame:
    """Keep rows all of whose junctions are among ``passing`` (contig, start0, end0)."""
    spliced, plain = _spliced(alignments)
    good = passing.select("contig", F.col("start0").alias("j_start0"), F.col("end0").alias("j_end0")).distinct()
    good = stage(good, "passing-junctions")
    failing = lookup_join(_read_introns(spliced), good, ["contig", "j_start0", "j_end0"], "left_anti",
                          ["read_name"], _JUNCTION_ROWS)
    return plain.unionByName(spliced.join(failing.select(*READ_KEY), READ_KEY, "left_anti"))


def keep_unmapped(aligned: DataFrame, fragments: DataFrame) -> DataFrame:
    """Alignments plus one unmapped row for every fragment end that has none."""
    paired = F.col("seq2").isNotNull()
    first = F.struct(F.when(paired, 77).otherwise(4).alias("flag"), F.when(paired, 64).otherwise(0).alias("m"),
                     F.col("seq1").alias("sequence"), F.col("qual1").alias("qualities"))
    second = F.struct(F.lit(141).alias("flag"), F.lit(128).alias("m"), F.col("seq2").alias("sequence"),
                      F.col("qual2").alias("qualities"))
    ends = F.filter(F.array(first, second), lambda e: e["sequence"].isNotNull())
    raw = (fragments.select(F.col("name").alias("read_name"), F.explode(ends).alias("e"))
           .select("read_name", F.col("e.flag").alias("flag"), F.col("e.m").alias("_m"),
                   F.col("e.sequence").alias("sequence"), F.col("e.qualities").alias("qualities")))
    seen = aligned.select("read_name", mate_bits().alias("_m")).distinct()
    missing = raw.join(seen, ["read_name", "_m"], "left_anti").drop("_m")
    filled = (missing.withColumn("cigar", F.lit("*")).withColumn("mapq", F.lit(0))
              .withColumn("tlen", F.lit(0).cast("bigint")))
    return aligned.unionByName(filled, allowMissingColumns=True)


def split_as_secondary(alignments: DataFrame) -> DataFrame:
    """Of the pieces of a split read the longest stays primary, the others become 0x100 instead of 0x800."""
    piece = has_none(0x104)
    rank = F.row_number().over(W.partitionBy("read_name", mate_bits(), piece).orderBy(
        aligned_length("cigar").desc(), F.col("flag").bitwiseAND(0x800), "contig", "start0"))
    cleared = F.col("flag").bitwiseAND(~0x800)
    return (alignments.withColumn("_rank", rank)
            .withColumn("flag", F.when(~piece, F.col("flag")).when(F.col("_rank") == 1, cleared)
                        .otherwise(cleared.bitwiseOR(0x100)))
            .drop("_rank"))


def mate_join(reads: DataFrame) -> DataFrame:
    """One row per read name: ``r1`` and ``r2`` structs of the primary reads, and whether both exist."""
    columns = [c for c in reads.columns if c not in ("read_name", "tags")]
    whole = F.struct(*columns)
    return (reads.where(has_none(0x900)).groupBy("read_name")
            .agg(F.max(F.when(~sam_flag_is("second_in_pair"), whole)).alias("r1"),
                 F.max(F.when(sam_flag_is("second_in_pair"), whole)).alias("r2"))
            .withColumn("mated", F.col("r1").isNotNull() & F.col("r2").isNotNull()))


def union_known_sites(*sites: DataFrame) -> DataFrame:
    """Several site sets as one set of distinct (contig, start0, end0)."""
    spans = [s.select("contig", "start0", "end0") for s in sites]
    merged = spans[0]
    for other in spans[1:]:
        merged = merged.unionByName(other)
    return merged.distinct()


def union_samples(cohort: dict[str, DataFrame]) -> DataFrame:
    """Reads of several samples together, labelled by sample."""
    parts = [df.withColumn("sample", F.lit(name)) for name, df in cohort.items()]
    merged = parts[0]
    for other in parts[1:]:
        merged = merged.unionByName(other, allowMissingColumns=True)
    return merged


def revert_reads(reads: DataFrame) -> DataFrame:
    """Aligned reads back to raw fragments in sequencing orientation, primary rows only."""
    back = sam_flag_is("reverse")
    raw = reads.where(has_none(0x900)).select(
        "read_name", sam_flag_is("second_in_pair").alias("_second"),
        F.struct(F.when(back, reverse_complement("sequence")).otherwise(F.col("sequence")).alias("s"),
                 F.when(back, F.reverse("qualities")).otherwise(F.col("qualities")).alias("q")).alias("e"))
    return (raw.groupBy(F.col("read_name").alias("name"))
            .agg(F.max(F.when(~F.col("_second"), F.col("e"))).alias("a"),
                 F.max(F.when(F.col("_second"), F.col("e"))).alias("b"))
            .select("name", F.col("a.s").alias("seq1"), F.col("a.q").alias("qual1"),
                    F.col("b.s").alias("seq2"), F.col("b.q").alias("qual2")))
