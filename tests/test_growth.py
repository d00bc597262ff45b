"""What must not grow with the tables: copied join sides, lone writers, work done twice."""
import datetime
import re
import time

import pytest
from pyspark.sql import functions as F

import helixframe.functions as fn
from checks import fixtures
from checks.queries import QUERIES
from helixframe.operators import align, bases, intervals, realign, recal
from helixframe.runtime import salted_join
from helixframe.sources import sam
from helixframe.sources.sam import scan_sam


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    """Source tables of a few hundred rows, keys that repeat and nulls included."""
    when = datetime.datetime(2020, 1, 1)
    items = [(k // 3, k % 41 + 1, k % 10 + 1, k % 7 + 1, float(k % 50), when) for k in range(400)]
    items += [(None, 3, 4, 1, 2.0, when), (5, None, 4, 1, 2.0, when), (5, 3, None, 1, None, when)] + items[:5]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp") \
        .coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_derived_tables_are_the_rows_of_their_sql(spark, tables):
    fx, items = fixtures.Fixture(spark, tables), spark.read.parquet(f"{tables}/lineitem.parquet")
    reads = spark.sql(fixtures.SQL["reads"], lineitem=items)
    whole = spark.sql(fixtures.alignments_sql("explode(sequence(1, 24))", "SELECT * FROM {reads}"), reads=reads)
    for got, want in ((fx.reads, reads), (fx.alignments, whole), (fx.fragments, spark.sql(fixtures.SQL["fragments"], lineitem=items))):
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_reads_of_one_file_are_derived_without_a_shuffle_and_in_many_tasks(spark, tables):
    reads = fixtures.Fixture(spark, tables).reads
    assert "Exchange" not in _plan(reads)
    assert "md5" not in _plan(reads.select("read_name", "flag"))
    assert reads.rdd.getNumPartitions() > 1


def test_copied_side_of_a_salted_join_is_not_broadcast(spark):
    left = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("v"))
    right = spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    for how, rows in (("inner", 5), ("left", 100), ("left_semi", 5), ("left_anti", 95)):
        joined = salted_join(left, right, ["k"], how, ["v"])
        assert "Broadcast" not in _plan(joined)
        assert joined.count() == rows


def test_text_of_all_reads_has_more_than_one_writer(spark, tables):
    files = [f for f in QUERIES["scan_sam"](spark, tables).inputFiles() if "/sam-" in f]
    assert len(files) > 1


def test_tolerant_trimming_aligns_every_read_once(spark):
    rows = [("a", "ACGT" * 10 + "AGATCGGA", "I" * 48, "ACGT" * 12, "I" * 48)]
    df = spark.createDataFrame(rows, "name string, seq1 string, qual1 string, seq2 string, qual2 string")
    out = align.adapter_trim(df, fixtures.ADAPTER_FWD, fixtures.ADAPTER_REV, error_rate=0.1)
    assert _plan(out).count("ArrowEvalPython") <= 2 and _plan(out).count("cut(") == 2
    assert [len(out.first()[c]) for c in ("seq1", "seq2")] == [40, 48]


def test_numbers_of_many_digits_are_still_told_apart(spark, tmp_path):
    fields = ["r", "0", "chr1", "1", "9", "4M", "*", "0", "0", "ACGT", "IIII"]

    def line(at, value):
        return "\t".join([*fields[:at], value, *fields[at + 1:]])

    good = [line(3, "12345678901"), line(8, "-00000000000005"), line(5, "*"), line(5, "2M1I1M")]
    bad = [line(1, "99999999999"), line(4, "9x"), line(5, "4"), "\t".join(fields[:10]), line(3, "123456789012345678901")]
    path = tmp_path / "x.sam"
    path.write_text("\n".join(good + bad) + "\n")
    got = scan_sam(spark, str(path), "SILENT").select("start0", "tlen", "cigar").collect()
    assert sorted(map(tuple, got)) == [(0, -5, "4M"), (0, 0, "*"), (0, 0, "2M1I1M"), (12345678900, 0, "4M")]


def test_quality_strings_are_not_taken_apart_letter_by_letter(spark):
    rows = [("I/0",), ("",), (None,), ("é!~",), ("5I",)]
    df = spark.createDataFrame(rows, "q string").coalesce(1)
    decoded = fn.phred_decode("q")
    out = df.select(decoded.alias("d"), fn.phred_encode(decoded).alias("e"), fn.quality_sum("q", 15).alias("s"))
    assert "lambdafunction" not in _plan(out)
    assert [tuple(r) for r in out.collect()] == [([40, 14, 15], "I/0", 55), ([], "", 0), (None, None, None), ([200, 0, 93], "é!~", 293), ([20, 40], "5I", 60)]
    lists = spark.createDataFrame([([1, None, 40],), (None,), ([],), ([-40, 300, 93],), ([None],)], "a array<int>").coalesce(1)
    assert [r[0] for r in lists.select(fn.phred_encode("a")).collect()] == ['"I', None, "", "M~", ""]


def test_a_clip_that_is_not_there_is_not_cast(spark):
    """A failed try_cast throws and catches an exception, for each read."""
    df = spark.createDataFrame([("36M", 0), ("6S30M", 6), ("2H6S30M", 8), ("2H30M", 2), ("30M6S", 0), ("*", 0), (None, 0)], "cigar string, want int").coalesce(1)
    clip = fn.unclipped_5p("cigar", F.lit(0), F.lit(1), F.lit(False))
    assert "contains" in _plan(df.select(clip)).lower()
    assert all(-r[0] == r[1] for r in df.select(clip, "want").collect())


def test_a_reference_too_long_to_broadcast_is_not_copied(spark, monkeypatch):
    monkeypatch.setattr(bases, "_BROADCAST_BYTES", 1)
    blocks = spark.createDataFrame([("c", 0, "ACGT"), ("c", 1, "TTTT")], "contig string, block bigint, seq string")
    reads = spark.createDataFrame([("c", 2, "4M", "GTTT")], "contig string, start0 bigint, cigar string, sequence string")
    out = bases.with_reference(bases.aligned_pieces(reads, ["contig", "sequence"], 4), blocks, 4)
    assert "SortMergeJoin" in _plan(out) and "_salt" not in _plan(out)
    assert sorted(r.ref for r in out.collect()) == ["GT", "TT"]


def test_rows_of_a_wide_join_are_shuffled_once_and_not_written(spark):
    a = spark.range(300).selectExpr("concat('x', id) as name", "'chr1' as contig", "id * 10 as start0", "id * 10 + 300 as end0", "repeat('A', 50) as text")
    a = a.unionByName(spark.createDataFrame([("none", None, None, None, "A")], "name string, contig string, start0 bigint, end0 bigint, text string"))
    b = spark.range(60).selectExpr("'chr1' as contig", "id * 50 as start0", "id * 50 + 7 as end0", "id as k")
    want = a.join(b.select(F.col("contig").alias("c"), F.col("start0").alias("s"), F.col("end0").alias("e"), "k"), F.expr("contig = c and start0 < e and s < end0"), "left")
    for how in ("inner", "left", "left_semi", "left_anti"):
        out = intervals.overlap_join(a, b, how, broadcast_bytes=0)
        assert "left-rows" not in " ".join(out.inputFiles()) and _plan(out).count("SortMergeJoin") == 1
    got = intervals.overlap_join(a, b, "left", broadcast_bytes=0)
    assert sorted(map(str, got.select("name", "r_k").collect())) == sorted(map(str, want.select("name", F.col("k").alias("r_k")).collect()))


def test_tables_of_read_groups_that_fit_are_sent_to_the_reads(spark):
    reads = spark.createDataFrame([("a", 0, "ACGT", "IIII", "g1"), ("b", 16, "ACGA", "I5I5", "g2"), ("c", 0, "AC", "III", "g1"), ("d", 0, "AC", "II", None),
                                   ("e", 0, None, None, "g1"), ("f", 0, "", "", "g3")], "read_name string, flag int, sequence string, qualities string, read_group string").withColumn("start0", F.lit(1))
    table = spark.createDataFrame([(g, q, c, x, 50, 3) for g in ("g1", "g2", "") for q, c, x in (
        (None, None, None), (40, None, None), (40, 1, None), (40, None, "NA"), (20, None, None), (20, -2, None))],
        "read_group string, quality int, cycle int, context string, observations bigint, mismatches bigint")
    near = recal.apply_recalibration(reads, table)
    assert "hashpartitioning" not in _plan(near)
    assert near.schema == reads.schema and sorted(map(str, near.collect())) == sorted(map(str, recal.apply_recalibration(reads, table, broadcast_bytes=-1).collect()))


def test_realignment_makes_the_bases_of_a_read_twice_at_most(spark):
    """Once to try it on the candidates, once to give it back."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def bases_of(text):
        made.add(1)
        return text

    ref = spark.createDataFrame([("chr1", 0, "ACGTTGCAAGCTTACGGATCCATTGACCGTAAGCTGGTCA")], "contig string, block bigint, seq string")
    rows = [(f"r{k}", 0, "chr1", 10, 20, "10M", "CTTACGGATC") for k in range(50)] + [("d", 0, "chr1", 10, 22, "5M2D5M", "CTTACATCCA")]
    reads = spark.createDataFrame(rows, "read_name string, flag int, contig string, start0 bigint, end0 bigint, cigar string, sequence string").withColumns(
        {"sequence": bases_of.asNondeterministic()("sequence"), "qualities": F.lit("I" * 10)})
    targets = spark.createDataFrame([("chr1", 5, 25)], "contig string, start0 bigint, end0 bigint")
    assert realign.realign_indels(reads, targets, ref, width=40).count() == 51
    assert realign.realign_indels(reads, targets, ref, width=40).agg(F.max("sequence")).first()[0]
    assert made.value <= 4 * 51


def test_code_of_the_reads_is_compiled(spark, tables):
    """The digests are not in the one method of the whole stage, and a filter on end0 names the lengths once."""
    plan = _plan(fixtures.Fixture(spark, tables).reads.where("end0 > start0").select("sequence"))
    assert not [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("*") and "md5(" in line]
    assert plan.count("THEN 86") <= 2


def test_covariates_are_counted_without_a_row_for_each_base(spark):
    ref = spark.createDataFrame([("chr1", 0, "ACGTACGTAC"), ("chr1", 1, "GGTTNA")], "contig string, block bigint, seq string")
    rows = [("a", 0, 2, "6M", "GTACGT", "IIIIII", "x"), ("b", 16 + 128, 8, "4M", "ACGG", "5555", None), ("short", 0, 0, "4M", "AT", "II", "x"),
            ("none", 0, 0, "2M", "AC", None, "x"), ("uneven", 0, 0, "2M", "AC", "I", "x"), ("wide", 0, 0, "2M", "\u4e16C", "II", "x")]
    reads = spark.createDataFrame(rows, "read_name string, flag int, start0 bigint, cigar string, sequence string, qualities string, read_group string").withColumn("contig", F.lit("chr1"))
    table = recal.recalibration_table(reads, ref, None, 10)
    assert "ascii(" not in _plan(table)
    got = {(r.read_group, r.quality, r.cycle, r.context): (r.observations, r.mismatches) for r in table.collect()}
    assert got["x", None, None, None] == (12, 4)  # a base of "short" and the two that it lacks differ, and the wide letter
    assert got["x", -33, 3, None] == (1, 1) and got["x", -33, None, "T"] == (1, 1) and got["x", -33, None, ""] == (1, 1)
    assert got["", 20, None, None] == (4, 0)
    assert {c: got["", 20, c, None] for c in (-1, -2, -3, -4)} == {c: (1, 0) for c in (-1, -2, -3, -4)}
    assert got["", 20, None, "NC"] == (1, 0) and got["", 20, None, "GT"] == (1, 0)


def test_the_sample_of_a_long_path_is_told_in_one_pass():
    """A name without a suffix was tried from each letter, at each length and for each rest."""
    name = re.compile(sam._FILE_SAMPLE)
    for path, sample in (("file:/a/S1.x.sam", "S1"), ("/a/b.sam/part-0", "b"), ("/a.sam/b.sam", "a"), ("/x/.hid.sam.gz", "hid"), ("/x/y.sam.bam", None), ("c.sam", "c")):
        assert (name.search(path) or [None, None])[1] == sample
    start = time.perf_counter()
    assert name.search("/" + "a" * 4000 + "/S.sam")[1] == "S"
    assert time.perf_counter() - start < 2
