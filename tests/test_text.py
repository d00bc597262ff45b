"""Text sources and sinks on tiny files, and the malformed-record modes."""
import os

import pytest
from pyspark.sql import functions as F

from helixframe import sinks
from helixframe.sources import fasta, fastq, features, manifest, sam, vcf
from helixframe.sources.stringency import REPORTS

SAM = """@HD\tVN:1.6
@SQ\tSN:chr1\tLN:1000
@SQ\tSN:chr2\tLN:500
@RG\tID:a\tLB:libA\tSM:sA
@RG\tID:b\tLB:libB\tPL:ILLUMINA\tSM:sB
r1\t99\tchr1\t11\t60\t4M\t=\t31\t24\tACGT\tIIII\tRG:Z:a\tNM:i:0
r1\t147\tchr1\t31\t60\t2S2M\t=\t11\t-24\tACGT\tIIII\tRG:Z:a
r2\t16\tchr2\t1\t7\t2M5N2M\t*\t0\t0\tACGT\tI@II\tRG:Z:b
r3\t4\t*\t0\t0\t*\t*\t0\t0\tACGT\tIIII
"""


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return f"file://{path}"


def test_sam(spark, tmp_path):
    path = put(tmp_path, "x.sam", SAM)
    rows = {(r.read_name, r.flag): r for r in sam.scan_sam(spark, path).collect()}
    assert len(rows) == 4
    a = rows[("r1", 99)]
    assert (a.contig, a.start0, a.end0, a.mate_contig, a.mate_start0, a.library, a["sample"], a.tags["NM"]) == (
        "chr1", 10, 14, "chr1", 30, "libA", "sA", "0")
    assert rows[("r2", 16)].end0 == 9 and rows[("r1", 147)].end0 == 32
    u = rows[("r3", 4)]
    assert (u.contig, u.start0, u.end0, u.read_group) == (None, None, None, None)
    assert {tuple(r) for r in sam.sam_contigs(spark, path).collect()} == {("chr1", 1000), ("chr2", 500)}


def test_malformed_lines(spark, tmp_path):
    path = put(tmp_path, "x.sam", SAM + "broken\tline\n" + "r9\tx\tchr1\t1\t0\t4M\t*\t0\t0\tACGT\tIIII\n")
    with pytest.raises(Exception, match="malformed SAM line"):
        sam.scan_sam(spark, path).select("flag").collect()
    assert sam.scan_sam(spark, path, "SILENT").count() == 4
    assert len(sam.scan_sam(spark, path, "LENIENT").collect()) == 4
    assert REPORTS["SAM line"].get["dropped"] == 2


def test_sam_round_trip(spark, tmp_path):
    first = sam.scan_sam(spark, put(tmp_path, "x.sam", SAM))
    contigs = spark.createDataFrame([("chr2", 0, 500), ("chr1", 1, 1000)], "contig string, ordinal int, length bigint")
    for single in (True, False):
        out = str(tmp_path / f"out{single}")
        sinks.write_sam(first, contigs, out, single=single)
        parts = sorted(f for f in os.listdir(out) if f.startswith("part"))
        assert not single or len(parts) == 1
        text = "".join((tmp_path / f"out{single}" / p).read_text() for p in parts).splitlines()
        assert text[0].startswith("@HD") and [t.split("\t")[0] for t in text if t[0] != "@"] == ["r2", "r1", "r1", "r3"]
        again = sam.scan_sam(spark, out)
        key = lambda r: (r.read_name, r.flag)
        assert sorted(first.collect(), key=key) == sorted(again.collect(), key=key)


def test_columnar_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "reads")
    sam.reads_to_columnar(sam.scan_sam(spark, put(tmp_path, "x.sam", SAM)), path, by_position=True)
    from helixframe.operators.filters import aligned_reads
    df = aligned_reads(sam.scan_columnar_reads(spark, path)).select("read_name")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(mapped,true)" in plan and "sequence" not in plan.split("ReadSchema")[1]
    assert df.count() == 3


def test_fastq_pair_with_at_as_quality(spark, tmp_path):
    r1 = put(tmp_path, "r1.fq", "@a/1\nACGT\n+\n@III\n@b/1 comment\nGG\n+b\nI@\n")
    r2 = put(tmp_path, "r2.fq", "@a/2\nTTTT\n+\n@@@@\n@b/2\nCC\n+\n@I\n")
    rows = sorted(fastq.scan_fastq(spark, r1, r2).collect(), key=lambda r: r.record)
    assert [tuple(r)[1:] for r in rows] == [("a", "ACGT", "@III", "TTTT", "@@@@"), ("b", "GG", "I@", "CC", "@I")]
    assert fastq.scan_fastq(spark, r1).where("seq2 is null").count() == 2
    out1, out2 = str(tmp_path / "o1"), str(tmp_path / "o2")
    sinks.write_fastq(fastq.scan_fastq(spark, r1, r2), out1, out2, order="record")
    assert sorted(map(tuple, fastq.scan_fastq(spark, out1, out2).collect())) == sorted(map(tuple, rows))
    bad = put(tmp_path, "bad.fq", "@a\nACGT\n+\nIII\n@b\nGG\n+\nII\n")
    assert [r.name for r in fastq.scan_fastq(spark, bad, mode="SILENT").collect()] == ["b"]


def test_fastq_pairs_that_do_not_match(spark, tmp_path):
    r1 = put(tmp_path, "r1.fq", "@a/1\nAC\n+\nII\n@b/1\nGG\n+\nII\n@c/1\nTT\n+\nII\n")
    r2 = put(tmp_path, "r2.fq", "@a/2\nTT\n+\nII\n@x/2\nCC\n+\nII\n")
    assert [r.name for r in fastq.scan_fastq(spark, r1, r2, mode="SILENT").collect()] == ["a"]
    with pytest.raises(Exception, match="malformed FASTQ pair"):
        fastq.scan_fastq(spark, r1, r2).count()


def test_fasta_and_its_index(spark, tmp_path):
    path = put(tmp_path, "ref.fa", ">one first\nACGTA\nCCGTT\nGG\n>two\nTTTTT\nA\n")
    blocks = {(r.contig, r.block): r.seq for r in fasta.scan_fasta(spark, path, 4).collect()}
    assert blocks == {("one", 0): "ACGT", ("one", 1): "ACCG", ("one", 2): "TTGG", ("two", 0): "TTTT", ("two", 1): "TA"}
    assert {tuple(r) for r in fasta.fasta_index(spark, path).collect()} == {("one", 12, 11, 5, 6), ("two", 6, 31, 5, 6)}


FORMATS = {
    "t.bed": "track name=x\nchr1\t10\t20\texon a\t5.0\t+\nchr2\t0\t7\tb\t6.0\t-\n",
    "t.gtf": '#c\nchr1\ts\texon\t11\t20\t5.0\t+\t.\tgene_id "g"; name "exon a";\nchr2\ts\texon\t1\t7\t6.0\t-\t.\tname "b"; tag "x"; tag "y";\n',
    "t.gff3": "##gff-version 3\nchr1\ts\texon\t11\t20\t5.0\t+\t.\tName=exon%20a;x=1+1\nchr2\ts\texon\t1\t7\t6.0\t-\t.\tID=b\n",
    "t.interval_list": "@HD\tVN:1.6\nchr1\t11\t20\t+\texon a\nchr2\t1\t7\t-\tb\n",
    "t.narrowPeak": "chr1\t10\t20\texon a\t5.0\t+\t1.5\t2\t3\t4\nchr2\t0\t7\tb\t6.0\t-\t1\t2\t3\t4\n",
}


@pytest.mark.parametrize("name", FORMATS)
def test_feature_formats_agree(spark, tmp_path, name):
    df = features.scan_features(spark, put(tmp_path, name, FORMATS[name]))
    got = {(r.contig, r.start0, r.end0, r.name, r.strand) for r in df.collect()}
    assert got == {("chr1", 10, 20, "exon a", "+"), ("chr2", 0, 7, "b", "-")}
    if name == "t.gff3":
        assert df.where("contig = 'chr1'").first().attributes["x"] == "1+1"
    out = str(tmp_path / "again")
    df.write.parquet(out)
    assert sorted(map(str, features.scan_features(spark, out).collect())) == sorted(map(str, df.collect()))
    gff = str(tmp_path / "gff")
    sinks.write_gff3(df, gff)
    back = features.scan_gff3(spark, gff).select("contig", "start0", "end0", "name", "strand")
    assert {tuple(r) for r in back.collect()} == got


def test_vcf(spark, tmp_path):
    text = ("##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\n"
            "chr1\t5\trs1\tAC\tA,T\t30\tPASS\t.\tGT:GQ\t0/1:9\t1|2\nchr1\t9\t.\tG\t.\t.\tPASS\t.\tGT\t./.\t0/0\n")
    path = put(tmp_path, "x.vcf", text)
    sites = {r.start0: r for r in vcf.scan_vcf(spark, path).collect()}
    assert (sites[4].end0, sites[4].alt, sites[4].id, sites[4].qual) == (6, ["A", "T"], "rs1", 30.0)
    assert sites[8].alt == [] and sites[8].id is None
    calls = {(r.start0, r["sample"]): r for r in vcf.scan_vcf(spark, path, sites_only=False).collect()}
    assert calls[(4, "A")].alleles == [0, 1] and calls[(4, "B")].alleles == [1, 2] and calls[(8, "A")].alleles == [None, None]
    assert calls[(4, "A")].fields["GQ"] == "9" and calls[(4, "B")].fields["GQ"] is None


def test_write_vcf_fills_missing_samples(spark, tmp_path):
    rows = [("B", "chr1", 4, "A", "T", [0, 1], 30, [30, 0, 40]), ("A", "chr2", 1, "G", "C", [1, 1], 9, [0, 9, 20]),
            ("A", "chr1", 4, "A", "T", [1, 1], 12, [0, 12, 50])]
    calls = spark.createDataFrame(rows, "sample string, contig string, pos0 bigint, ref string, alt string, alleles array<int>, gq int, pl array<int>")
    contigs = spark.createDataFrame([("chr2", 0, 10), ("chr1", 1, 10)], "contig string, ordinal int, length bigint")
    out = str(tmp_path / "v")
    sinks.write_vcf(calls, contigs, out, single=True)
    lines = [r.value for r in spark.read.text(out).collect() if not r.value.startswith("##")]
    assert lines == ["#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB",
                     "chr2\t2\t.\tG\tC\t.\tPASS\t.\tGT:GQ:PL\t1/1:9:0,9,20\t./.",
                     "chr1\t5\t.\tA\tT\t.\tPASS\t.\tGT:GQ:PL\t1/1:12:0,12,50\t0/1:30:30,0,40"]


def test_manifest(spark, tmp_path):
    a, b = put(tmp_path, "first.sam", SAM), put(tmp_path, "second.v2.sam", SAM)
    columnar = str(tmp_path / "third.parquet")
    sam.reads_to_columnar(sam.scan_sam(spark, a), columnar)
    listing = put(tmp_path, "m.txt", f"{a}  \n\n{b}\nfile://{columnar}\n")
    cohort = manifest.scan_manifest(spark, listing)
    assert {(r["sample"], r["count"]) for r in cohort.groupBy("sample").count().collect()} == {("first", 4), ("second", 4), ("third", 4)}
    with pytest.raises(ValueError, match="schemes"):
        manifest.scan_manifest(spark, put(tmp_path, "n.txt", "/no/scheme.sam\n"))


def test_bedgraph_prefix(spark, tmp_path):
    signal = spark.createDataFrame([("chr1", 5, 9, 2), ("chr1", 1, 5, 1), ("HLA", 0, 4, 1)], "contig string, start0 bigint, end0 bigint, depth bigint")
    out = str(tmp_path / "bg")
    sinks.write_bedgraph(signal, out, single=True)
    assert [r.value for r in spark.read.text(out).collect()] == ["chr1\t1\t5\t1", "chr1\t5\t9\t2"]


def test_many_splits_keep_line_order(spark, tmp_path):
    from helixframe.sources.lines import carry_last, numbered_lines, running_sum
    text = "".join(f"{'>' if i % 37 == 0 else ''}{i}\n" for i in range(5000))
    path = put(tmp_path, "long.txt", text)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = numbered_lines(spark, path).withColumn("head", F.when(F.col("value").startswith(">"), F.col("line")))
        rows = running_sum(carry_last(lines, "head", "h", 100).withColumn("one", F.lit(1)), ["h"], "one", "n", 100).collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 5000
    assert all(r.value.lstrip(">") == str(r.line) and r.h == r.line // 37 * 37 and r.n == r.line % 37 for r in rows)
