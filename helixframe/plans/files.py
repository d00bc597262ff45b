"""The chains from files to files: text or columnar inputs, one written output that the readers of this library take back."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators.bases import BLOCK_WIDTH
from helixframe.operators.cnv import cnvs_as_features
from helixframe.operators.filters import aligned_reads, limit_projection
from helixframe.plans.chains import align_reads, call_cnvs, call_variants, preprocess_reads, preprocess_reads_with_known_indels
from helixframe.runtime import scratch_path, stage
from helixframe.schemas import READS
from helixframe.sinks.text import write_gff3, write_sam, write_vcf
from helixframe.sources.fasta import fasta_contigs, scan_fasta
from helixframe.sources.fastq import scan_fastq
from helixframe.sources.features import scan_features
from helixframe.sources.manifest import LOCAL_SCHEMES, scan_manifest
from helixframe.sources.sam import reads_to_columnar, scan_columnar_reads, scan_sam
from helixframe.sources.vcf import scan_vcf


def _reads_of(spark: SparkSession, path: str, mode: str) -> DataFrame:
    """Columnar reads; SAM text is converted first, so that later filters and projections reach the scan."""
    if not path.endswith((".sam", ".sam.gz")):
        return scan_columnar_reads(spark, path)
    columnar = scratch_path(spark, "columnar-reads")
    reads_to_columnar(scan_sam(spark, path, mode), columnar)
    return scan_columnar_reads(spark, columnar)


def _reference(spark: SparkSession, fasta: str, width: int) -> tuple[DataFrame, DataFrame]:
    """Reference blocks and the dictionary of contigs, written once each."""
    return stage(scan_fasta(spark, fasta, width), "reference"), stage(fasta_contigs(spark, fasta), "contigs")


def _plain(reads: DataFrame) -> DataFrame:
    return limit_projection(reads, [f.name for f in READS.fields])


def preprocess_files(spark: SparkSession, reads: str, fasta: str, out: str, sites: str | None = None, *, single: bool = False,
                     mode: str = "STRICT", width: int = BLOCK_WIDTH) -> None:
    """Mapped reads of a SAM or columnar file: duplicates marked, realigned, recalibrated outside the sites of a VCF, sorted, written as SAM."""
    blocks, contigs = _reference(spark, fasta, width)
    known = stage(scan_vcf(spark, sites, mode=mode), "known-sites") if sites else None
    table = _plain(aligned_reads(_reads_of(spark, reads, mode)))
    write_sam(preprocess_reads(table, known, blocks, contigs, width, sort=False), contigs, out, single)


def preprocess_files_with_known_indels(spark: SparkSession, reads: str, fasta: str, out: str, g1k: str, mills: str, dbsnp: str, *,
                                       realign: bool = True, single: bool = False, mode: str = "STRICT", width: int = BLOCK_WIDTH) -> None:
    """As ``preprocess_files``, unmapped reads included, with realignment at the indels of two VCF files and the sites of a third masked."""
    blocks, contigs = _reference(spark, fasta, width)
    sets = [stage(scan_vcf(spark, path, mode=mode), "known-sites") for path in (g1k, mills, dbsnp)]
    table = _plain(_reads_of(spark, reads, mode))
    write_sam(preprocess_reads_with_known_indels(table, blocks, contigs, *sets, realign=realign, width=width, sort=False), contigs, out, single)


def call_variants_files(spark: SparkSession, reads: str, fasta: str, out: str, *, contig_style: str | None = None, single: bool = False,
                        mode: str = "STRICT", width: int = BLOCK_WIDTH) -> None:
    """Genotypes of the samples of a SAM or columnar file as a VCF in the order of the reference."""
    blocks, contigs = _reference(spark, fasta, width)
    write_vcf(call_variants(_plain(_reads_of(spark, reads, mode)), blocks, contig_style, width), contigs, out, single)


def call_cnvs_files(spark: SparkSession, manifest: str, targets: str, out_dir: str, *, schemes=LOCAL_SCHEMES, single: bool = False,
                    mode: str = "STRICT", **model) -> str:
    """Copy number calls of the cohort of a manifest over a file of target regions, as ``cnvs.gff`` in ``out_dir``; gives its path."""
    regions = stage(scan_features(spark, targets, mode), "targets")
    cohort = stage(scan_manifest(spark, manifest, schemes, mode), "cohort")
    out = f"{out_dir.rstrip('/')}/cnvs.gff"
    write_gff3(cnvs_as_features(call_cnvs(cohort, regions, **model)), out, single)
    return out


def align_files(spark: SparkSession, r1: str, fasta: str, out: str, r2: str | None = None, rg_line: str | None = None, *, single: bool = False,
                mode: str = "STRICT", width: int = BLOCK_WIDTH, **options) -> None:
    """FASTQ files placed on the reference, labelled with their read group, as SAM in coordinate order."""
    blocks, contigs = _reference(spark, fasta, width)
    placed = stage(align_reads(scan_fastq(spark, r1, r2, mode), blocks, rg_line, width=width, **options), "placed")
    if "read_group" not in placed.columns:
        placed = placed.withColumns({c: F.lit(None).cast("string") for c in ("read_group", "library", "sample")})
    names = [c for c in ("read_group", "library", "sample", "platform", "unit") if c in placed.columns]
    write_sam(placed, contigs, out, single, placed.where("read_group is not null").select(*names).distinct())
