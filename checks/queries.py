"""Registered queries: each runs one operator over whole derived tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import helixframe.functions as fn
from checks.fixtures import ADAPTER_FWD, ADAPTER_REV, BLOCK, Fixture
from helixframe import plans, sinks
from helixframe.operators import (align, bases, cnv, duplicates, filters, intervals, metrics, realign, recal, rna,
                                  sorts, variants)
from helixframe.runtime import scratch_path, stage
from helixframe.sources import fasta, fastq, features, manifest, sam, vcf
from helixframe.sources.stringency import stringency

QUERIES: dict = {}
QUERY_OF: dict = {}
_READ = ["read_name", "flag", "contig", "start0", "end0", "mapq", "cigar", "mate_contig", "mate_start0", "tlen",
         "sequence", "qualities", "read_group", "library", "sample"]
_LOCUS = ["read_name", "flag", "contig", "start0", "cigar"]
_RG = "@RG\\tID:rg1\\tLB:libA\\tPL:ILLUMINA\\tPU:u1\\tSM:A\\n@RG\\tID:rg2\\tLB:libB\\tPL:ILLUMINA\\tPU:u2\\tSM:B"
#: Depth thresholds that suit the shallow derived cohort.
_DEPTHS = dict(min_target_depth=0.05, min_sample_depth=0.01)


def query(make):
    QUERY_OF[make.__name__] = make
    QUERIES[make.__name__] = lambda spark, sf_dir: make(Fixture(spark, sf_dir))
    return make


def _write_lines(fx: Fixture, lines: DataFrame, label: str, name: str = "") -> str:
    path = scratch_path(fx.spark, label) + name
    lines.write.text(path)
    return path


def _tabbed(*columns) -> F.Column:
    return F.concat_ws("\t", *[F.col(c).cast("string") if isinstance(c, str) else c for c in columns]).alias("value")


def _sam_text(reads: DataFrame):
    def star(c):
        return F.coalesce(F.col(c), F.lit("*"))
    return reads.select(_tabbed("read_name", "flag", star("contig"), (F.coalesce(F.col("start0") + 1, F.lit(0))).cast("string"),
                                "mapq", "cigar", star("mate_contig"), F.coalesce(F.col("mate_start0") + 1, F.lit(0)).cast("string"),
                                "tlen", "sequence", "qualities", F.concat(F.lit("RG:Z:"), F.col("read_group"))))


def _rg_lines(reads: DataFrame) -> DataFrame:
    return reads.select("read_group", "library", "sample").distinct().select(_tabbed(
        F.lit("@RG"), F.concat(F.lit("ID:"), F.col("read_group")), F.concat(F.lit("LB:"), F.col("library")),
        F.concat(F.lit("SM:"), F.col("sample"))))


# ---- sources -------------------------------------------------------------------------------------------------

@query
def scan_sam(fx):
    text = _rg_lines(fx.reads).unionByName(_sam_text(fx.reads))
    return sam.scan_sam(fx.spark, _write_lines(fx, text, "sam")).select(*_READ)


@query
def reads_to_columnar(fx):
    path = scratch_path(fx.spark, "columnar")
    sam.reads_to_columnar(fx.reads, path)
    return sam.scan_columnar_reads(fx.spark, path).select(*_READ, "mapped")


def _variant_text(fx):
    both = fx.known_sites.unionByName(fx.known_indels)
    return both.select(_tabbed("contig", (F.col("start0") + 1).cast("string"), "id", "ref", "alt", F.lit("50"), F.lit("PASS"),
                               F.lit(".")))


@query
def scan_vcf(fx):
    return vcf.scan_vcf(fx.spark, _write_lines(fx, _variant_text(fx), "vcf")).select(
        "contig", "start0", "end0", "ref", F.array_join("alt", ",").alias("alt"), "id", "qual")


@query
def scan_fastq(fx):
    def side(i):
        text = F.concat_ws("\n", F.concat(F.lit("@"), F.col("name"), F.lit(f"/{i}")), f"seq{i}", F.lit("+"), f"qual{i}")
        return _write_lines(fx, fx.fragments.select(text.alias("value"), "name").orderBy("name").select("value"), "fastq")
    return fastq.scan_fastq(fx.spark, side(1), side(2)).drop("record")


def _fasta_path(fx):
    body = fx.ref_blocks.select("contig", "block", F.col("seq").alias("value"))
    heads = fx.contigs.select("contig", F.lit(-1).cast("bigint").alias("block"), F.concat(F.lit(">"), F.col("contig")).alias("value"))
    return _write_lines(fx, body.unionByName(heads).orderBy("contig", "block").select("value"), "fasta")


@query
def scan_fasta(fx):
    return fasta.scan_fasta(fx.spark, _fasta_path(fx), 1000)


@query
def fasta_index(fx):
    return fasta.fasta_index(fx.spark, _fasta_path(fx))


_FEATURE = ["contig", "start0", "end0", "name", "score", "strand"]
_GENE = ["contig", "start0", "end0", "name", "score", "strand", "source", "type"]


@query
def scan_bed(fx):
    return features.scan_bed(fx.spark, _write_lines(fx, fx.targets.select(_tabbed(*_FEATURE)), "bed")).select(*_FEATURE)


def _nine(fx, last):
    start = (F.col("start0") + 1).cast("string")
    return fx.targets.select(_tabbed("contig", "source", "type", start, "end0", "score", "strand", F.lit("."), last))


@query
def scan_gtf(fx):
    last = F.concat(F.lit('gene_id "g'), F.col("name"), F.lit('"; name "'), F.col("name"), F.lit('"; level 2;'))
    got = features.scan_gtf(fx.spark, _write_lines(fx, _nine(fx, last), "gtf"))
    return got.select(*_GENE, F.col("attributes")["gene_id"].alias("gene_id"), F.col("attributes")["level"].alias("level"))


@query
def scan_gff3(fx):
    last = F.concat(F.lit("ID="), F.col("name"), F.lit(";Note=a%3Bb "), F.col("source"))
    got = features.scan_gff3(fx.spark, _write_lines(fx, _nine(fx, last), "gff3"))
    return got.select(*_GENE, F.col("attributes")["Note"].alias("note"))


@query
def scan_interval_list(fx):
    text = fx.targets.select(_tabbed("contig", (F.col("start0") + 1).cast("string"), "end0", "strand", "name"))
    head = fx.contigs.select(_tabbed(F.lit("@SQ"), F.concat(F.lit("SN:"), F.col("contig")), F.concat(F.lit("LN:"), F.col("length"))))
    path = _write_lines(fx, head.unionByName(text), "intervals")
    return features.scan_interval_list(fx.spark, path).select("contig", "start0", "end0", "name", "strand")


@query
def scan_narrowpeak(fx):
    text = fx.targets.select(_tabbed(*_FEATURE, "score", F.lit("-1"), F.lit("-1"), F.lit("25")))
    got = features.scan_narrowpeak(fx.spark, _write_lines(fx, text, "peaks"))
    return got.select(*_FEATURE, F.col("attributes")["signalValue"].cast("double").alias("signal"),
                      F.col("attributes")["peak"].cast("int").alias("peak"))


@query
def scan_features_parquet(fx):
    path = scratch_path(fx.spark, "features")
    fx.targets.write.parquet(path)
    return features.scan_features_parquet(fx.spark, path).select(*_GENE)


@query
def scan_manifest(fx):
    root = scratch_path(fx.spark, "cohort")
    names = [r[0] for r in fx.reads.select("sample").distinct().collect()]
    for name in names:
        _sam_text(fx.reads.where(F.col("sample") == name)).write.text(f"{root}/{name}.sam")
    listing = fx.spark.createDataFrame([(f"file://{root}/{n}.sam ",) for n in names] + [("",)], "value string")
    path = _write_lines(fx, listing, "manifest")
    return manifest.scan_manifest(fx.spark, path, ("file",)).select(*_LOCUS, "sample")


@query
def stringency_lenient(fx):
    bad = F.col("score") > 40
    text = fx.targets.select(_tabbed("contig", F.when(bad, "x").otherwise(F.col("start0").cast("string")), "end0", "name"))
    return features.scan_bed(fx.spark, _write_lines(fx, text, "bed"), "LENIENT").select("contig", "start0", "end0", "name")


@query
def stringency_silent(fx):
    return stringency(fx.reads, "SILENT", F.length("sequence") != fn.query_length("cigar"), "sequence").select(*_LOCUS)


# ---- sinks ---------------------------------------------------------------------------------------------------

@query
def write_sam(fx):
    path = scratch_path(fx.spark, "out-sam")
    sinks.write_sam(fx.reads, fx.contigs, path)
    return fx.spark.read.text(path).withColumnRenamed("value", "line")


def _calls(fx):
    return plans.call_variants(fx.reads, fx.ref_blocks, width=BLOCK)


@query
def write_vcf(fx):
    path = scratch_path(fx.spark, "out-vcf")
    sinks.write_vcf(_calls(fx), fx.contigs, path)
    return fx.spark.read.text(path).where(~F.col("value").startswith("##")).withColumnRenamed("value", "line")


@query
def write_gff3(fx):
    path = scratch_path(fx.spark, "out-gff3")
    sinks.write_gff3(fx.targets.withColumn("attributes", F.create_map(F.lit("brand"), F.concat("source", F.lit(";x")))), path)
    return fx.spark.read.text(path).withColumnRenamed("value", "line")


@query
def write_bedgraph(fx):
    path = scratch_path(fx.spark, "out-bedgraph")
    sinks.write_bedgraph(metrics.coverage_signal(fx.reads), path)
    return fx.spark.read.text(path).withColumnRenamed("value", "line")


@query
def write_fastq(fx):
    r1, r2 = scratch_path(fx.spark, "out-r1"), scratch_path(fx.spark, "out-r2")
    sinks.write_fastq(fx.fragments, r1, r2)
    return fastq.scan_fastq(fx.spark, r1, r2).drop("record")


# ---- filters and projections ---------------------------------------------------------------------------------

@query
def aligned_reads(fx):
    return filters.aligned_reads(fx.reads).select(*_LOCUS)


@query
def limit_projection(fx):
    return filters.limit_projection(fx.reads, ["read_name", "flag", "mapq"])


@query
def flag_filter(fx):
    return filters.flag_filter(fx.reads, 66, 16).select(*_LOCUS)


@query
def multimap_filter(fx):
    return filters.multimap_filter(fx.alignments, 20).select(*_LOCUS)


@query
def mismatch_filter(fx):
    tagged = align.attach_tags(fx.reads, fx.ref_blocks, BLOCK).where("nm is not null")
    return filters.mismatch_filter(tagged).select("read_name", "flag", F.col("nm").cast("bigint").alias("nm"))


@query
def intron_mate_filter(fx):
    return filters.intron_mate_filter(fx.alignments, 20, 1_000_000, 60).select(*_LOCUS)


@query
def overhang_filter(fx):
    return filters.overhang_filter(fx.alignments, fx.junctions, 18, 1).select(*_LOCUS)


@query
def by_junction_filter(fx):
    passing = rna.splice_junctions(fx.alignments, fx.junctions).where("annotated or unique_reads > 1")
    return filters.by_junction_filter(fx.alignments, passing).select(*_LOCUS)


@query
def keep_unmapped(fx):
    mapped = filters.aligned_reads(fx.reads)
    return filters.keep_unmapped(mapped, filters.revert_reads(fx.reads)).select("read_name", "flag", "contig", "sequence", "qualities")


@query
def attach_tags(fx):
    return align.attach_tags(fx.alignments, fx.ref_blocks, BLOCK).select(
        *_LOCUS, F.col("nh").cast("bigint").alias("nh"), F.col("hi").cast("bigint").alias("hi"), F.col("nm").cast("bigint").alias("nm"))


@query
def split_as_secondary(fx):
    return filters.split_as_secondary(fx.alignments).select(*_LOCUS)


@query
def assign_read_group(fx):
    return align.assign_read_group(fx.reads, _RG).select("read_name", "flag", "read_group", "library", "sample", "platform")


_PAIR = ["name", "seq1", "qual1", "seq2", "qual2"]


@query
def adapter_trim(fx):
    return align.adapter_trim(fx.fragments, ADAPTER_FWD, ADAPTER_REV).select(*_PAIR)


@query
def adapter_trim_tolerant(fx):
    return align.adapter_trim(fx.fragments, ADAPTER_FWD, ADAPTER_REV, error_rate=0.1).select(*_PAIR)


@query
def revert_reads(fx):
    return filters.revert_reads(fx.alignments)


# ---- sorts ---------------------------------------------------------------------------------------------------

@query
def sort_coordinate(fx):
    return sorts.sort_coordinate(fx.reads, fx.contigs, rank=True).select("read_name", "flag", "rank")


@query
def sort_queryname(fx):
    return sorts.sort_queryname(fx.reads, rank=True).select("read_name", "flag", "rank")


@query
def sort_variants(fx):
    both = fx.known_sites.unionByName(fx.known_indels)
    return sorts.sort_variants(both, fx.contigs, rank=True).select("contig", "start0", "id", "rank")


# ---- joins and sets ------------------------------------------------------------------------------------------

def _mapped(fx):
    return filters.aligned_reads(fx.reads)


@query
def overlap_join(fx):
    return intervals.overlap_join(_mapped(fx), fx.targets).select(
        "read_name", "flag", F.col("r_name").alias("name"), intervals.overlap_bases().alias("bases"))


@query
def overlap_join_left(fx):
    return intervals.overlap_join(_mapped(fx), fx.targets, "left", key=_LOCUS).select(
        "read_name", "flag", F.col("r_name").alias("name"))


@query
def overlap_join_semi(fx):
    return intervals.overlap_join(_mapped(fx), fx.known_sites, "left_semi", key=_LOCUS).select(*_LOCUS)


@query
def overlap_join_anti(fx):
    return intervals.overlap_join(_mapped(fx), fx.known_sites, "left_anti", key=_LOCUS).select(*_LOCUS)


def _bases(fx):
    pieces = bases.aligned_pieces(_mapped(fx), ["contig", "read_name", "sequence", "qualities", "cigar", "start0"], BLOCK)
    return bases.base_rows(bases.with_reference(pieces, fx.ref_blocks, BLOCK), ["contig", "read_name"])


@query
def known_site_mask(fx):
    left = recal.known_site_mask(_bases(fx), fx.known_sites)
    return left.groupBy("contig", F.expr("pos0 div 100").alias("stretch")).agg(
        F.count("*").alias("bases"), F.sum((F.col("base") != F.col("ref_base")).cast("int")).alias("mismatches"))


@query
def reads_in_targets(fx):
    return realign.reads_in_targets(fx.reads, fx.targets).select("read_name", "flag", "target_start0", "target_end0")


@query
def project_to_transcripts(fx):
    return rna.project_to_transcripts(fx.alignments, fx.exons)


@query
def mate_join(fx):
    return filters.mate_join(fx.alignments).select(
        "read_name", F.col("r1.start0").alias("start_1"), F.col("r2.start0").alias("start_2"), F.col("r1.flag").alias("flag_1"),
        F.col("r2.flag").alias("flag_2"), "mated")


@query
def union_known_sites(fx):
    return filters.union_known_sites(fx.known_sites, fx.known_indels, fx.known_sites)


@query
def union_samples(fx):
    ends = {"first": filters.flag_filter(fx.reads, 64), "second": filters.flag_filter(fx.reads, 128)}
    return filters.union_samples(ends).select("sample", *_LOCUS)


# ---- aggregations --------------------------------------------------------------------------------------------

@query
def mean_insert_size(fx):
    return metrics.mean_insert_size(fx.reads)


@query
def sequence_dictionary(fx):
    return metrics.sequence_dictionary(fx.ref_blocks)


@query
def genomic_bin_index(fx):
    return metrics.genomic_bin_index(fx.reads)


@query
def region_lookup(fx):
    return metrics.region_lookup(metrics.with_bins(_mapped(fx)), "chr2", 1000, 90000).select(*_LOCUS)


def _depth(fx):
    return metrics.target_coverage(fx.reads, fx.targets)


@query
def target_coverage(fx):
    return _depth(fx).withColumn("mean_depth", F.round("mean_depth", 6))


@query
def coverage_signal(fx):
    return metrics.coverage_signal(fx.reads, window=4096)


@query
def splice_junctions(fx):
    return rna.splice_junctions(fx.alignments, fx.junctions)


@query
def alignment_summary(fx):
    return metrics.alignment_summary(fx.alignments).drop("mismatch_rate").withColumn("mean_length", F.round("mean_length", 6))


@query
def duplicate_metrics(fx):
    return duplicates.duplicate_metrics(duplicates.mark_duplicates(fx.reads)).drop("library_size").withColumn(
        "fraction_duplicate", F.round("fraction_duplicate", 6))


@query
def recalibration_table(fx):
    return recal.recalibration_table(fx.reads, fx.ref_blocks, fx.known_sites, BLOCK)


@query
def pileup(fx):
    return variants.pileup(fx.reads, fx.ref_blocks, width=BLOCK).groupBy(
        "sample", "contig", F.expr("pos0 div 500").alias("stretch"), "ref_base", "allele").agg(
        F.count("*").alias("cells"), *[F.sum(c).alias(c) for c in ("n", "ll0", "ll1", "ll2")])


# ---- domain operators ----------------------------------------------------------------------------------------

@query
def mark_duplicates(fx):
    return duplicates.mark_duplicates(fx.reads).select(*_LOCUS)


@query
def mark_duplicates_alignments(fx):
    return duplicates.mark_duplicates(fx.alignments).select(*_LOCUS)


@query
def remove_duplicates(fx):
    return duplicates.remove_duplicates(fx.reads).select(*_LOCUS)


@query
def mark_duplicates_by_name(fx):
    return duplicates.mark_duplicates_by_name(fx.reads).select(*_LOCUS)


@query
def realignment_targets(fx):
    return realign.realignment_targets(fx.reads, fx.known_indels, window=4096)


@query
def realign_gains(fx):
    targets = realign.realignment_targets(fx.reads, fx.known_indels)
    return realign.candidate_gains(fx.reads, targets, fx.ref_blocks, fx.known_indels, width=BLOCK)


@query
def realign_indels(fx):
    targets = realign.realignment_targets(fx.reads, fx.known_indels)
    return realign.realign_indels(fx.reads, targets, fx.ref_blocks, fx.known_indels, width=BLOCK).select(*_LOCUS, "end0")


@query
def realign_indels_low_threshold(fx):
    targets = realign.realignment_targets(fx.reads, fx.known_indels)
    return realign.realign_indels(fx.reads, targets, fx.ref_blocks, fx.known_indels, lod=0.3, width=BLOCK).select(*_LOCUS, "end0")


@query
def apply_recalibration(fx):
    table = stage(recal.recalibration_table(fx.reads, fx.ref_blocks, fx.known_sites, BLOCK), "recalibration")
    return recal.apply_recalibration(fx.reads, table).select("read_name", "flag", "qualities")


@query
def genotype_biallelic(fx):
    return variants.genotype_biallelic(variants.pileup(fx.reads, fx.ref_blocks, width=BLOCK), "grc").select(
        "sample", "contig", "pos0", "ref", "alt", "n_ref", "n_alt", "ref_alleles", F.array_join("pl", ",").alias("pl"), "gq")


@query
def genotype_joint(fx):
    return variants.genotype_joint(fx.reads, fx.ref_blocks, width=BLOCK).select(
        "sample", "contig", "pos0", "ref", "alt", "n_ref", "n_alt", "ref_alleles", F.array_join("pl", ",").alias("pl"), "gq")


@query
def cnv_filter_matrix(fx):
    kept = cnv.cnv_filter_matrix(stage(_depth(fx), "target-depth"), **_DEPTHS)
    return kept.select("sample", "target", F.round("value", 9).alias("value"))


def _centred(fx):
    return cnv.cnv_filter_matrix(stage(_depth(fx), "target-depth"), **_DEPTHS)


@query
def cnv_pca_normalise(fx):
    return cnv.cnv_pca_normalise(_centred(fx)).withColumn("value", F.round("value", 6))


@query
def cnv_zscore(fx):
    return cnv.cnv_zscore(_centred(fx), 1.0).select("sample", "target", F.round("z", 6).alias("z"))


@query
def cnv_discover(fx):
    return cnv.cnv_discover(cnv.cnv_zscore(_centred(fx)), p=1e-3, n=6, scale=70e3)


@query
def kmer_index(fx):
    return align.kmer_index(fx.ref_blocks, 8, 12)


@query
def align_seed_vote(fx):
    index = align.kmer_index(fx.ref_blocks, 12, 16)
    return align.seed_vote_hits(fx.fragments, index, fx.ref_blocks, 12, 6, width=BLOCK)


# ---- scalar functions ----------------------------------------------------------------------------------------

@query
def cigar_functions(fx):
    return _mapped(fx).select(
        "read_name", "flag", F.size(fn.cigar_ops("cigar")).alias("n_ops"), fn.ref_length("cigar").alias("ref_length"),
        fn.query_length("cigar").alias("query_length"),
        fn.unclipped_5p("cigar", "start0", "end0", fn.sam_flag_is("reverse")).alias("unclipped_5p"))


@query
def phred_functions(fx):
    decoded = fn.phred_decode("qualities")
    return fx.reads.select(
        "read_name", "flag", fn.phred_encode(decoded).alias("encoded"), fn.quality_sum("qualities", 15).cast("bigint").alias("score"),
        F.round(fn.error_prob(decoded[0]), 8).alias("first_error"))


@query
def reverse_complement(fx):
    return fx.reads.select("read_name", "flag", fn.reverse_complement("sequence").alias("rc"))


@query
def sam_flag_is(fx):
    return fx.reads.select("read_name", "flag", *[fn.sam_flag_is(n).alias(n) for n in ("proper_pair", "reverse", "first_in_pair")])


@query
def contig_style(fx):
    return fx.reads.select("read_name", "flag", fn.contig_style("contig", "grc").alias("grc"),
                           fn.contig_style(fn.contig_style("contig", "grc"), "ucsc").alias("ucsc"))


# ---- chains --------------------------------------------------------------------------------------------------

@query
def preprocess_reads(fx):
    return plans.preprocess_reads(fx.reads, fx.known_sites, fx.ref_blocks, fx.contigs, BLOCK).select(*_LOCUS, "qualities")


@query
def call_variants(fx):
    return _calls(fx).select("sample", "contig", "pos0", "ref", "alt", "ref_alleles", "gq")


@query
def call_cnvs(fx):
    return plans.call_cnvs(fx.reads, fx.targets, p=1e-3, **_DEPTHS)


@query
def align_reads(fx):
    placed = plans.align_reads(fx.fragments, fx.ref_blocks, _RG.split("\\n")[0], fwd=ADAPTER_FWD, rev=ADAPTER_REV, k=12, stride=6,
                               max_freq=16, width=BLOCK)
    return placed.select(*_LOCUS, "mapq", "sequence", "qualities", "read_group", "sample")


@query
def preprocess_reads_with_known_indels(fx):
    return plans.preprocess_reads_with_known_indels(
        fx.reads, fx.ref_blocks, fx.contigs, fx.known_indels, fx.known_indels, fx.known_sites, width=BLOCK).select(
        "read_name", "flag", "qualities")


# ---- chains from files to files ------------------------------------------------------------------------------

_RG1 = _RG.split("\\n")[0]


def _sam_path(fx: Fixture, reads: DataFrame) -> str:
    """Reads as a folder of several SAM parts, header in the first one."""
    path = scratch_path(fx.spark, "input") + ".sam"
    sinks.write_sam(reads, fx.contigs, path)
    return path


@query
def sam_folder_round_trip(fx):
    return sam.scan_sam(fx.spark, _sam_path(fx, fx.reads)).select(*_READ)


@query
def align_files(fx):
    def side(i):
        text = F.concat_ws("\n", F.concat(F.lit("@"), F.col("name"), F.lit(f"/{i}")), f"seq{i}", F.lit("+"), f"qual{i}")
        return _write_lines(fx, fx.fragments.select(text.alias("value"), "name").orderBy("name").select("value"), "fastq")

    out = scratch_path(fx.spark, "aligned") + ".sam"
    plans.align_files(fx.spark, side(1), _fasta_path(fx), out, side(2), _RG1, fwd=ADAPTER_FWD, rev=ADAPTER_REV, k=12, stride=6, max_freq=16, width=BLOCK)
    return sam.scan_sam(fx.spark, out).select(*_LOCUS, "mapq", "sequence", "qualities", "read_group", "sample")


@query
def call_variants_files(fx):
    out = scratch_path(fx.spark, "called") + ".vcf"
    plans.call_variants_files(fx.spark, _sam_path(fx, fx.reads), _fasta_path(fx), out, width=BLOCK)
    return fx.spark.read.text(out).where(~F.col("value").startswith("##")).withColumnRenamed("value", "line")


@query
def call_cnvs_files(fx):
    """One SAM folder a sample, a manifest that names them, targets as BED; the calls read back from cnvs.gff."""
    root = scratch_path(fx.spark, "cohort")
    names = [r[0] for r in fx.reads.select("sample").distinct().collect()]
    for name in names:
        sinks.write_sam(fx.reads.where(F.col("sample") == name), fx.contigs, f"{root}/{name}.sam")
    listing = _write_lines(fx, fx.spark.createDataFrame([(f"file://{root.removeprefix('file://')}/{n}.sam",) for n in names], "value string"), "manifest")
    bed = _write_lines(fx, fx.targets.select(_tabbed(*_FEATURE)), "targets", ".bed")
    out = plans.call_cnvs_files(fx.spark, listing, bed, root, schemes=("file",), p=1e-3, **_DEPTHS)
    return features.scan_gff3(fx.spark, out).select("contig", "start0", "end0", "type", F.col("attributes")["sample"].alias("sample"))


def _vcf_path(fx: Fixture, variants: DataFrame) -> str:
    return _write_lines(fx, variants.select(_tabbed("contig", (F.col("start0") + 1).cast("string"), "id", "ref", "alt", F.lit("50"), F.lit("PASS"), F.lit("."))), "sites", ".vcf")


@query
def preprocess_files(fx):
    out = scratch_path(fx.spark, "preprocessed") + ".sam"
    plans.preprocess_files(fx.spark, _sam_path(fx, fx.reads), _fasta_path(fx), out, _vcf_path(fx, fx.known_sites), width=BLOCK)
    return sam.scan_sam(fx.spark, out).select(*_LOCUS, "qualities")


@query
def preprocess_files_with_known_indels(fx):
    """With realignment at the known indels; no candidate of these tables passes the default threshold, so reads stay where they are."""
    out, indels = scratch_path(fx.spark, "preprocessed") + ".sam", _vcf_path(fx, fx.known_indels)
    plans.preprocess_files_with_known_indels(fx.spark, _sam_path(fx, fx.reads), _fasta_path(fx), out, indels, indels, _vcf_path(fx, fx.known_sites), width=BLOCK)
    return sam.scan_sam(fx.spark, out).select("read_name", "flag", "qualities")


# ---- comparisons of variants of one operator on the same reads ----------------------------------------------

def _tally(**variants: DataFrame) -> DataFrame:
    """One row a variant: rows and a sum over what it gives."""
    parts = [df.agg(F.lit(name).alias("variant"), F.count("*").alias("n_rows"), F.coalesce(F.sum(df.columns[0]), F.lit(0)).cast("bigint").alias("total")) for name, df in variants.items()]
    out = parts[0]
    for other in parts[1:]:
        out = out.unionByName(other)
    return out


@query
def bench_sort(fx):
    weighed = lambda df: df.select((F.col("rank") * (F.col("flag") + 1)).alias("x"))
    return _tally(coordinate=weighed(QUERY_OF["sort_coordinate"](fx)), queryname=weighed(QUERY_OF["sort_queryname"](fx)))


@query
def bench_duplicates(fx):
    marked = lambda name: QUERY_OF[name](fx).select("flag")
    return _tally(mark=marked("mark_duplicates"), remove=marked("remove_duplicates"), by_name=marked("mark_duplicates_by_name"))


@query
def bench_recalibration(fx):
    return _tally(table=recalibration_table(fx).select("observations"), apply=apply_recalibration(fx).select(F.ascii(F.col("qualities").substr(5, 1)).alias("q")))


@query
def bench_realignment(fx):
    return _tally(targets=realignment_targets(fx).select((F.col("end0") - F.col("start0")).alias("w")), gains=realign_gains(fx).select("gain"),
                  realign=realign_indels(fx).select("end0"))
