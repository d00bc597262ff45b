"""The five chains. Plans are written out where two branches read the same rows; some operators count rows to choose a plan."""
from __future__ import annotations

from pyspark.sql import DataFrame

from helixframe.operators.align import adapter_trim, align_seed_vote, assign_read_group, kmer_index
from helixframe.operators.bases import BLOCK_WIDTH
from helixframe.operators.cnv import cnv_discover, cnv_filter_matrix, cnv_pca_normalise, cnv_zscore
from helixframe.operators.duplicates import mark_duplicates
from helixframe.operators.filters import aligned_reads, union_known_sites
from helixframe.operators.metrics import target_coverage
from helixframe.operators.realign import realign_indels, realignment_targets
from helixframe.operators.recal import apply_recalibration, recalibration_table
from helixframe.operators.sorts import sort_coordinate
from helixframe.operators.variants import genotype_joint
from helixframe.runtime import stage


def _recalibrate(reads: DataFrame, ref_blocks: DataFrame, sites: DataFrame | None, width: int) -> DataFrame:
    recal = stage(recalibration_table(reads, ref_blocks, sites, width), "recalibration")
    return apply_recalibration(reads, recal)


def preprocess_reads(reads: DataFrame, sites: DataFrame | None, ref_blocks: DataFrame, contigs: DataFrame,
                     width: int = BLOCK_WIDTH, sort: bool = True) -> DataFrame:
    """Mapped reads, duplicates marked, realigned, recalibrated, in coordinate order."""
    marked = stage(mark_duplicates(aligned_reads(reads)), "marked")
    moved = stage(realign_indels(marked, realignment_targets(marked), ref_blocks, width=width), "realigned")
    out = _recalibrate(moved, ref_blocks, sites, width)
    return sort_coordinate(out, contigs) if sort else out


def preprocess_reads_with_known_indels(reads: DataFrame, ref_blocks: DataFrame, contigs: DataFrame, g1k: DataFrame,
                                       mills: DataFrame, dbsnp: DataFrame, realign: bool = False,
                                       width: int = BLOCK_WIDTH, sort: bool = True) -> DataFrame:
    """Duplicates marked, optionally realigned at the first two site sets, recalibrated with the last two."""
    marked = stage(mark_duplicates(reads), "marked")
    if realign:
        columns = ["contig", "start0", "end0", "ref", "alt"]
        indels = g1k.select(*columns).unionByName(mills.select(*columns))
        marked = stage(realign_indels(marked, realignment_targets(marked, indels), ref_blocks, indels, width=width), "realigned")
    out = _recalibrate(marked, ref_blocks, union_known_sites(dbsnp, mills), width)
    return sort_coordinate(out, contigs) if sort else out


def call_variants(reads: DataFrame, ref_blocks: DataFrame, contig_style: str | None = None,
                  width: int = BLOCK_WIDTH) -> DataFrame:
    """Genotypes of all covered samples at the sites where one of them differs. Sort and save with ``write_vcf``."""
    return genotype_joint(aligned_reads(reads), ref_blocks, contig_style, width=width)


def call_cnvs(reads: DataFrame, targets: DataFrame, *, pca_factor: float = 0.7, max_sd: float = 30, p: float = 1e-8,
              n: float = 6, scale: float = 70e3, **thresholds) -> DataFrame:
    """Copy number calls of a cohort of reads (``scan_manifest``) over target regions."""
    depth = stage(target_coverage(reads, targets), "target-depth")
    centred = cnv_filter_matrix(depth, **thresholds)
    return cnv_discover(cnv_zscore(cnv_pca_normalise(centred, pca_factor), max_sd), p, n, scale)


def align_reads(fragments: DataFrame, ref_blocks: DataFrame, rg_line: str | None = None, *, fwd: str | None = None,
                rev: str | None = None, k: int = 16, stride: int = 4, max_freq: int = 64, width: int = BLOCK_WIDTH,
                **read_group) -> DataFrame:
    """Trim (when adapters are given), place by seeds, and label the read group."""
    trimmed = adapter_trim(fragments, fwd, rev) if fwd else fragments
    index = kmer_index(ref_blocks, k, max_freq)
    placed = align_seed_vote(trimmed, index, ref_blocks, k, stride, width=width)
    return assign_read_group(placed, rg_line, **read_group)
