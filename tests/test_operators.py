"""Operators on small literal rows with results worked out by hand."""
import random

import pytest
from pyspark.sql import functions as F

import helixframe.functions as fn
from helixframe.operators import (align, cnv, duplicates, filters, intervals, metrics, realign, recal, rna, sorts,
                                  variants)
from helixframe.schemas import READS

REF = "ACGTTGCAAGCTTACGGATCCATTGACCGTAAGCTGGTCA"


def reads_df(spark, rows):
    base = dict(flag=0, contig="chr1", start0=0, mapq=60, cigar="10M", mate_contig=None, mate_start0=None, tlen=0,
                sequence="A" * 10, qualities="I" * 10, read_group="rg", library="lib", sample="s", tags=None)
    full = []
    for r in rows:
        d = {**base, **r}
        d.setdefault("end0", None)
        full.append([d.get(f.name) for f in READS.fields])
    df = spark.createDataFrame(full, READS)
    return df.withColumn("end0", F.coalesce("end0", F.when(F.col("flag").bitwiseAND(4) == 0, F.col("start0") + fn.ref_length("cigar"))))


def ref_df(spark, text=REF, width=10, contig="chr1"):
    rows = [(contig, i // width, text[i:i + width]) for i in range(0, len(text), width)]
    return spark.createDataFrame(rows, "contig string, block bigint, seq string")


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_cigar_functions(spark):
    df = spark.createDataFrame([("3S10M2D5M4I6M100N7M2S1H", 100)], "cigar string, start0 bigint")
    row = df.select(fn.ref_length("cigar").alias("r"), fn.query_length("cigar").alias("q"),
                    fn.leading_clip("cigar").alias("l"), fn.trailing_clip("cigar").alias("t"),
                    fn.aligned_blocks("cigar", "start0").alias("b"), fn.introns("cigar", "start0").alias("i"),
                    fn.indels("cigar", "start0").alias("d")).first()
    assert (row.r, row.q, row.l, row.t) == (130, 37, 3, 3)
    assert [tuple(b) for b in row.b] == [(100, 3, 10), (112, 13, 5), (117, 22, 6), (223, 28, 7)]
    assert [tuple(i) for i in row.i] == [(123, 223, 21, 7)]
    assert [tuple(d) for d in row.d] == [(110, 13, 2, 0), (117, 18, 0, 4)]


def test_scalar_functions(spark):
    row = spark.range(1).select(
        fn.reverse_complement(F.lit("AACGN")).alias("rc"), fn.phred_decode(F.lit("!I5")).alias("q"),
        fn.phred_encode(F.array(F.lit(0), F.lit(40))).alias("e"), fn.contig_style(F.lit("chrM"), "grc").alias("g"),
        fn.contig_style(F.lit("MT"), "ucsc").alias("u"), fn.error_prob(F.lit(20)).alias("p"),
        fn.quality_sum(F.lit("I/0"), 15).alias("s")).first()
    assert (row.rc, row.q, row.e, row.g, row.u, row.p, row.s) == ("NCGTT", [0, 40, 20], "!I", "MT", "chrM", 0.01, 55)


def test_mean_insert_size_and_its_default(spark):
    df = reads_df(spark, [dict(read_name="a", flag=67, tlen=100), dict(read_name="b", flag=67, tlen=-205),
                          dict(read_name="c", flag=67, tlen=10_000), dict(read_name="d", flag=131, tlen=7)])
    assert metrics.mean_insert_size(df).first()[0] == 152
    assert metrics.mean_insert_size(df.where("false")).first()[0] == 150


def brute_overlaps(left, right):
    return {(a[0], b[0]) for a in left for b in right if a[1] == b[1] and a[2] < b[3] and b[2] < a[3]}


@pytest.mark.parametrize("longest", [50, 40_000])
def test_overlap_join_equals_brute_force(spark, longest):
    rng = random.Random(longest)
    # A third of the left rows share one place.
    left = [(f"l{i}", "chr1", 500, 536) for i in range(60)] + [
        (f"m{i}", f"chr{rng.randint(1, 2)}", s := rng.randint(0, 50_000), s + rng.randint(1, 400)) for i in range(120)]
    right = [(f"r{i}", f"chr{rng.randint(1, 2)}", s := rng.randint(0, 50_000), s + rng.randint(1, longest)) for i in range(40)]
    right += [("hot", "chr1", 490, 510), ("empty", "chr1", 505, 505), ("touching", "chr1", 536, 540)]
    schema = "name string, contig string, start0 bigint, end0 bigint"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    expected = brute_overlaps(left, [r for r in right if r[2] < r[3]])
    got = [tuple(r) for r in intervals.overlap_join(a, b).select("name", "r_name").collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    hit = {x for x, _ in expected}
    assert {r.name for r in intervals.overlap_join(a, b, "left_semi", key=["name"]).collect()} == hit
    assert {r.name for r in intervals.overlap_join(a, b, "left_anti", key=["name"]).collect()} == {r[0] for r in left} - hit
    outer = intervals.overlap_join(a, b, "left", key=["name"]).select("name", "r_name").collect()
    assert {tuple(r) for r in outer if r.r_name} == expected and {r.name for r in outer if not r.r_name} == {r[0] for r in left} - hit


@pytest.mark.parametrize("size", [intervals.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("long_left", [False, True])
def test_overlap_join_broadcast_and_spread(spark, size, long_left):
    """Both ways of joining, with long left rows, hot bins, rows without a place, and left rows that are equal in every column."""
    rng = random.Random(7)
    left = [(f"l{i}", "chr1", 500, 536) for i in range(700)] + [("twin", "chr1", 480, 520)] * 2 + [
        (f"m{i}", f"chr{rng.randint(1, 3)}", s := rng.randint(0, 90_000), s + rng.choice([20, 300, 20_000 if long_left else 40])) for i in range(100)]
    left += [("none", None, None, None), ("nowhere", "chr9", 5, 50), ("void", "chr1", 505, 505)]
    right = [(f"r{i}", f"chr{rng.randint(1, 2)}", s := rng.randint(0, 90_000), s + rng.choice([1, 200, 3_000, 60_000])) for i in range(30)]
    right += [("hot", "chr1", 490, 510), ("empty", "chr1", 505, 505), ("unplaced", None, 1, 2)]
    schema = "name string, contig string, start0 bigint, end0 bigint"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    placed, real = [r for r in left if r[1] and r[2] < r[3]], [r for r in right if r[1] and r[2] < r[3]]
    expected = sorted((x[0], y[0]) for x in placed for y in real if x[1] == y[1] and x[2] < y[3] and y[2] < x[3])
    hit = {x for x, _ in expected}
    join = lambda how: intervals.overlap_join(a, b, how, broadcast_bytes=size)
    assert sorted(tuple(r) for r in join("inner").select("name", "r_name").collect()) == expected
    assert sorted(r.name for r in join("left_semi").collect()) == sorted(r[0] for r in left if r[0] in hit)
    alone = sorted(r[0] for r in left if r[0] not in hit)
    assert sorted(r.name for r in join("left_anti").collect()) == alone
    outer = [tuple(r) for r in join("left").select("name", "r_name").collect()]
    assert sorted(r for r in outer if r[1]) == expected and sorted(r[0] for r in outer if not r[1]) == alone


def test_a_target_list_does_not_shuffle_the_reads(spark):
    a = spark.range(1000).selectExpr("concat('x', id) as name", "'chr1' as contig", "id * 10 as start0", "id * 10 + 50 as end0")
    b = spark.createDataFrame([("chr1", 100, 250), ("chr1", 240, 900)], "contig string, start0 bigint, end0 bigint")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plan = intervals.overlap_join(a, b, how)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert intervals.overlap_join(a, b, "left_semi").count() == 84 and intervals.overlap_join(a, b, "left").count() == 1000 + 5


def test_merge_and_signal_across_stretches(spark):
    spans = spark.createDataFrame([("c", 0, 10), ("c", 10, 20), ("c", 15, 130), ("c", 140, 150), ("d", 3, 4)],
                                  "contig string, start0 bigint, end0 bigint")
    assert as_set(intervals.merge_intervals(spans, 16), "contig", "start0", "end0") == {("c", 0, 130), ("c", 140, 150), ("d", 3, 4)}
    df = reads_df(spark, [dict(read_name="a", start0=5), dict(read_name="b", start0=10), dict(read_name="c", start0=20, cigar="2M5N3M"),
                          dict(read_name="u", flag=4, contig=None, start0=None, cigar="*")])
    assert as_set(metrics.coverage_signal(df, 4), "start0", "end0", "depth") == {
        (5, 10, 1), (10, 15, 2), (15, 22, 1), (27, 30, 1)}


def pair(name, start, other, flag=99, mate_flag=147, quality="I", **more):
    return [dict(read_name=name, flag=flag, start0=start, qualities=quality * 10, **more),
            dict(read_name=name, flag=mate_flag, start0=other, qualities=quality * 10, **more)]


def test_mark_duplicates(spark):
    rows = (pair("p1", 100, 200, quality="5") + pair("p2", 100, 200) + pair("p3", 100, 200) + pair("p4", 100, 201)
            + pair("q1", 100, 200, library="other")
            # Clipped by two bases, so its unclipped start is that of the pairs.
            + [dict(read_name="p5", flag=99, start0=102, cigar="2S8M"), dict(read_name="p5", flag=147, start0=200)]
            # Lone reads: one meets an end of a pair, two share an end of their own.
            + [dict(read_name="x1", flag=73, start0=100), dict(read_name="x2", flag=73, start0=300, qualities="5" * 10),
               dict(read_name="x3", flag=73, start0=300)]
            + [dict(read_name="x1", flag=133, contig=None, start0=None, cigar="*")])
    marked = duplicates.mark_duplicates(reads_df(spark, rows))
    assert marked.count() == len(rows)
    dup = {r.read_name for r in marked.where(fn.sam_flag_is("duplicate")).collect()}
    assert dup == {"p1", "p3", "p5", "x1", "x2"}
    assert not marked.where(fn.sam_flag_is("duplicate") & fn.sam_flag_is("unmapped")).count()
    m = {r.library: r for r in duplicates.duplicate_metrics(marked).collect()}["lib"]
    assert (m.pairs_examined, m.pair_duplicates, m.unpaired_examined, m.unpaired_duplicates, m.unmapped) == (5, 3, 3, 2, 1)
    assert m.fraction_duplicate == pytest.approx(8 / 13)
    # Two distinct of five pairs: x (1 - exp(-5 / x)) = 2.
    assert m.library_size == 2
    by_name = duplicates.mark_duplicates_by_name(reads_df(spark, rows))
    assert {r.read_name for r in by_name.where(fn.sam_flag_is("duplicate")).collect()} == {"p2", "p3", "p5"}
    kept = duplicates.remove_duplicates(reads_df(spark, [dict(r, mapq=10 if r["read_name"] == "p1" else 5) for r in rows]))
    assert {r.read_name for r in kept.collect()} == {"p1", "p4", "q1", "x1", "x2", "x3"}


def test_one_hot_duplicate_group(spark):
    rows = [r for i in range(120) for r in pair(f"h{i:03d}", 100, 200)] + [r for i in range(120) for r in pair(f"c{i:03d}", 1000 + i, 2000)]
    marked = duplicates.mark_duplicates(reads_df(spark, rows))
    clean = {r.read_name for r in marked.where(~fn.sam_flag_is("duplicate")).collect()}
    assert clean == {"h000"} | {f"c{i:03d}" for i in range(120)}


def test_sorts_are_permutations_in_order(spark):
    rows = [dict(read_name=f"r{i}", contig=c, start0=s, flag=f) for i, (c, s, f) in enumerate(
        [("chr10", 5, 0), ("chr2", 9, 16), ("chr2", 9, 0), ("chr2", 1, 0), (None, None, 4)])]
    df = reads_df(spark, rows)
    contigs = spark.createDataFrame([("chr2", 0, 100), ("chr10", 1, 100)], "contig string, ordinal int, length bigint")
    ranked = sorts.sort_coordinate(df, contigs, rank=True)
    assert {r.read_name: r["rank"] for r in ranked.collect()} == {"r3": 1, "r2": 2, "r1": 3, "r0": 4, "r4": 5}
    assert [r.read_name for r in sorts.sort_coordinate(df, contigs).collect()] == ["r3", "r2", "r1", "r0", "r4"]


def test_recalibration_counts_and_application(spark):
    ref = ref_df(spark)
    wrong = REF[5:9] + "C" + REF[10:15]
    df = reads_df(spark, [dict(read_name="a", start0=5, sequence=wrong, qualities="5" * 10),
                          dict(read_name="b", flag=16, start0=20, sequence=REF[20:30], qualities="5" * 10),
                          dict(read_name="dup", flag=1024, start0=20, sequence="T" * 10, qualities="5" * 10)])
    sites = spark.createDataFrame([("chr1", 6, 7)], "contig string, start0 bigint, end0 bigint")
    table = recal.recalibration_table(df, ref, sites, 10).collect()
    top = [r for r in table if r.quality is None][0]
    assert (top.observations, top.mismatches) == (19, 1)
    fifth = {r.cycle: (r.observations, r.mismatches) for r in table if r.cycle is not None}
    assert fifth[5] == (2, 1) and fifth[2] == (1, 0)
    first_back = "N" + {"A": "T", "C": "G", "G": "C", "T": "A"}[REF[29]]
    assert [r.observations for r in table if r.context == first_back] == [1]
    applied = recal.apply_recalibration(df, recal.recalibration_table(df, ref, sites, 10)).where("read_name = 'a'").first()
    import math
    emp = {("q",): -10 * math.log10(2 / 21)}
    context = {r.context: (r.observations, r.mismatches) for r in table if r.context is not None}
    q = []
    for i in range(10):
        o, m = fifth[i + 1]
        ctx = ("N" if i == 0 else wrong[i - 1]) + wrong[i]
        co, cm = context.get(ctx, (None, None))
        v = -10 * math.log10((m + 1) / (o + 2))
        v += 0 if co is None else -10 * math.log10((cm + 1) / (co + 2)) - emp[("q",)]
        q.append(chr(33 + max(1, min(60, math.floor(v + 0.5)))))
    assert applied.qualities == "".join(q)


def test_recalibration_in_shares_is_the_same(spark):
    rng = random.Random(3)
    rows = [dict(read_name=f"r{i}", start0=(s := rng.randint(0, 30)), sequence=REF[s:s + 10], read_group=f"rg{i % 3}",
                 flag=rng.choice([0, 16, 128])) for i in range(60)]
    rows += [dict(read_name="other", read_group="none", flag=4, contig=None, start0=None, cigar="*"), dict(read_name="unnamed", read_group=None),
             dict(read_name="odd", read_group="rg0", qualities="II"), dict(read_name="bare", read_group="rg1", qualities=None),
             dict(read_name="tagged", read_group="rg2", start0=4, sequence=REF[4:14], tags={"NM": "0"})]
    df = reads_df(spark, rows)
    table = recal.recalibration_table(df, ref_df(spark), None, 10)
    whole = recal.apply_recalibration(df, table)
    assert whole.schema == df.schema and whole.count() == len(rows)
    for per_task in (1, 7):
        shared = recal.apply_recalibration(df, table, per_task=per_task)
        assert as_set(shared, "read_name", "qualities") == as_set(whole, "read_name", "qualities")
    kept = {r.read_name: (r.qualities, r.tags) for r in whole.collect()}
    assert kept["other"][0] == "I" * 10 and kept["odd"][0] == "II" and kept["bare"][0] is None and kept["tagged"][1] == {"NM": "0"}
    assert recal.apply_recalibration(df.where("false"), table).count() == 0
    assert as_set(recal.apply_recalibration(df, table.where("false")), "read_name", "qualities") == as_set(df, "read_name", "qualities")


def test_recalibration_of_many_read_groups(spark):
    """Each of several hundred read groups gets the qualities of its own table."""
    rng = random.Random(4)
    rows = []
    for g in range(300):
        for k in range(2):
            start = rng.randint(0, 30)
            text = list(REF[start:start + 10])
            if rng.random() < 0.5:
                at = rng.randrange(10)
                text[at] = "A" if text[at] != "A" else "C"
            rows.append(dict(read_name=f"r{g}-{k}", start0=start, sequence="".join(text), read_group=f"rg{g}"))
    df = reads_df(spark, rows)
    together = {r.read_name: r.qualities for r in recal.apply_recalibration(df, recal.recalibration_table(df, ref_df(spark), None, 10)).collect()}
    assert len(together) == 600 and len(set(together.values())) > 2
    for g in (0, 17, 299):
        one = df.where(f"read_group = 'rg{g}'")
        alone = recal.apply_recalibration(one, recal.recalibration_table(one, ref_df(spark), None, 10)).collect()
        assert {r.read_name: r.qualities for r in alone} == {k: v for k, v in together.items() if k.startswith(f"r{g}-")}


def test_planted_snp(spark):
    alt = "A" if REF[12] != "A" else "C"
    changed = REF[:12] + alt + REF[13:]
    rows = [dict(read_name=f"r{i}", start0=5 + i % 4, sequence=(changed if i % 2 else REF)[5 + i % 4:15 + i % 4]) for i in range(20)]
    rows += [dict(read_name=f"h{i}", start0=6, sequence=changed[6:16], sample="hom") for i in range(8)]
    for hot in (1, 1000):
        counts = variants.pileup(reads_df(spark, rows), ref_df(spark), width=10, hot_reads=hot)
        called = {r["sample"]: r for r in variants.genotype_biallelic(counts, "grc").collect()}
        assert (called["s"].pos0, called["s"].alleles, called["hom"].alleles) == (12, [0, 1], [1, 1])
        assert called["s"].contig == "1" and called["s"].alt == alt and called["s"].n_ref == 10
        assert called["s"].pl[1] == 0 and called["s"].gq == min(99, sorted(called["s"].pl)[1])


def test_planted_deletion_is_called(spark):
    rng = random.Random(1)
    regions = [(f"t{i}", "chr1", i * 1000, i * 1000 + 200) for i in range(200)]
    rows = []
    for s in range(12):
        for i, (t, c, a, b) in enumerate(regions):
            depth = 60 + 10 * (i % 5) + rng.gauss(0, 2)
            rows.append((f"s{s}", t, c, a, b, depth * (0.5 if s == 3 and 10 <= i < 13 else 1)))
    cover = spark.createDataFrame(rows, "sample string, target string, contig string, start0 bigint, end0 bigint, mean_depth double")
    centred = cnv.cnv_filter_matrix(cover)
    assert centred.count() == len(rows)
    clean = cnv.cnv_pca_normalise(centred, factor=50)
    assert clean.count() == len(rows)
    calls = cnv.cnv_discover(cnv.cnv_zscore(clean)).collect()
    assert [(r["sample"], r.type, r.start0, r.end0, r.targets) for r in calls] == [("s3", "DEL", 10_000, 12_200, 3)]
    assert calls[0].quality > 30


def test_pca_removes_a_shared_component(spark):
    rng = random.Random(2)
    rows = [(f"s{s}", f"t{t}", "c", t, t + 1, float((s - 3.5) * (t - 15) * 5 + rng.gauss(0, 1))) for s in range(8) for t in range(30)]
    matrix = spark.createDataFrame(rows, "sample string, target string, contig string, start0 bigint, end0 bigint, value double")
    clean = cnv.cnv_pca_normalise(matrix, factor=2)
    assert clean.agg(F.max(F.abs("value"))).first()[0] < 6


def test_coverage_keeps_zero_targets(spark):
    df = reads_df(spark, [dict(read_name="a", start0=0), dict(read_name="b", start0=5, sample="t"), dict(read_name="d", start0=0, flag=1024)])
    targets = spark.createDataFrame([("x", "chr1", 5, 15), ("y", "chr1", 50, 60)], "name string, contig string, start0 bigint, end0 bigint")
    got = as_set(metrics.target_coverage(df, targets), "sample", "target", "bases")
    assert got == {("s", "x", 5), ("t", "x", 10), ("s", "y", 0), ("t", "y", 0)}


def test_joint_genotypes_keep_samples_without_the_alternate(spark):
    alt, third = [b for b in "ACGT" if b != REF[12]][:2]
    read = lambda base: REF[8:12] + base + REF[13:18]
    rows = [dict(read_name=f"a{i}", start0=8, sequence=read(alt if i % 2 else REF[12]), sample="het") for i in range(12)]
    rows += [dict(read_name=f"b{i}", start0=8, sequence=read(REF[12]), sample="plain") for i in range(8)]
    rows += [dict(read_name=f"c{i}", start0=8, sequence=read(third), sample="other") for i in range(3)]
    rows += [dict(read_name="away", start0=25, sequence=REF[25:35], sample="away"), dict(read_name="dup", start0=8, sequence=read(third), flag=1024, sample="away")]
    for width in (10, 11, 40):
        found = {r["sample"]: r for r in variants.genotype_joint(reads_df(spark, rows), ref_df(spark, width=width), width=width).collect()}
        assert set(found) == {"het", "plain"}  # one sample has another base only, one has no read there
        assert [found[x].alleles for x in ("het", "plain")] == [[0, 1], [0, 0]] and found["plain"].alt == alt and found["plain"].n_ref == 8
        assert (found["het"].n_ref, found["het"].n_alt, found["het"].pos0) == (6, 6, 12)
    only = [r for r in rows if r["sample"] == "plain"]
    assert variants.genotype_joint(reads_df(spark, only), ref_df(spark), width=10).count() == 0


def test_realign_moves_reads_onto_the_deletion(spark):
    rng = random.Random(5)
    genome = "".join(rng.choice("ACGT") for _ in range(300))
    donor = genome[:150] + genome[154:]
    rows = [dict(read_name="seen", start0=130, cigar="20M4D20M", sequence=donor[130:170], qualities="I" * 40)]
    # Reads that end shortly after the deletion were placed without a gap.
    rows += [dict(read_name=f"m{i}", start0=113 + i, cigar="40M", sequence=donor[113 + i:153 + i], qualities="I" * 40) for i in range(3)]
    rows += [dict(read_name="far", start0=10, cigar="40M", sequence=genome[10:50], qualities="I" * 40)]
    df = reads_df(spark, rows)
    targets = realign.realignment_targets(df)
    assert as_set(targets, "contig", "start0", "end0") == {("chr1", 140, 164)}
    moved = {r.read_name: r for r in realign.realign_indels(df, targets, ref_df(spark, genome, 50), lod=1.0, width=50).collect()}
    for i in range(3):
        r = moved[f"m{i}"]
        assert (r.start0, r.cigar, r.end0) == (113 + i, f"{37 - i}M4D{3 + i}M", 157 + i)
    assert (moved["far"].start0, moved["far"].cigar, moved["seen"].cigar) == (10, "40M", "20M4D20M")
    twice = realign.realign_indels(df.unionByName(df), targets, ref_df(spark, genome, 50), lod=1.0, width=50)
    assert twice.count() == 2 * len(rows)
    still = realign.realign_indels(df, targets, ref_df(spark, genome, 50), lod=1.0, width=50, max_reads=3)
    assert as_set(still, "read_name", "cigar") == {(r["read_name"], r["cigar"]) for r in rows}


def test_known_indel_alone_realigns(spark):
    rng = random.Random(6)
    genome = "".join(rng.choice("ACGT") for _ in range(200))
    donor = genome[:100] + "GATTA" + genome[100:]
    rows = [dict(read_name=f"m{i}", start0=66 + i, cigar="40M", sequence=donor[66 + i:106 + i + 0], qualities="I" * 40) for i in range(4)]
    known = spark.createDataFrame([("chr1", 99, 100, genome[99], [genome[99] + "GATTA"])],
                                  "contig string, start0 bigint, end0 bigint, ref string, alt array<string>")
    df = reads_df(spark, rows)
    out = {r.read_name: r for r in realign.realign_indels(df, realign.realignment_targets(df, known), ref_df(spark, genome, 50), known,
                                                         lod=0.5, width=50).collect()}
    assert out["m3"].start0 == 69 and out["m3"].cigar == "31M5I4M"


def test_tags_and_md(spark):
    seq = REF[2:6] + ("A" if REF[6] != "A" else "C") + REF[7:10] + REF[12:16]
    df = reads_df(spark, [dict(read_name="a", start0=2, cigar="8M2D4M", sequence=seq, qualities="I" * 12),
                          dict(read_name="a", flag=256, start0=20, cigar="10M", sequence=REF[20:30]),
                          dict(read_name="u", flag=4, contig=None, start0=None, cigar="*")])
    for width in (10, 11, 40):
        rows = {(r.read_name, r.flag): r for r in align.attach_tags(df, ref_df(spark, width=width), width).collect()}
        a = rows[("a", 0)]
        assert (a.nh, a.hi, a.nm, a.md) == (2, 1, 3, f"4{REF[6]}3^{REF[10:12]}4")
        assert a["as"] == 11 - 4 - 6 - 2
        assert rows[("a", 256)].hi == 2 and rows[("a", 256)].md == "10" and rows[("u", 4)].nh is None


def test_seed_vote_brings_reads_home(spark):
    rng = random.Random(9)
    genome = "".join(rng.choice("ACGT") for _ in range(600))
    comp = str.maketrans("ACGT", "TGCA")
    frags = [(f"f{i}", genome[i * 7:i * 7 + 40], "I" * 40, genome[i * 7 + 60:i * 7 + 100].translate(comp)[::-1], "I" * 40) for i in range(60)]
    frags.append(("nowhere", "ACAC" * 10, "I" * 40, "GTGT" * 10, "I" * 40))
    df = spark.createDataFrame(frags, "name string, seq1 string, qual1 string, seq2 string, qual2 string")
    ref = ref_df(spark, genome, 64)
    placed = align.align_seed_vote(df, align.kmer_index(ref, 12, 10), ref, 12, 4, width=64).collect()
    assert len(placed) == 122
    for r in placed:
        if r.read_name == "nowhere":
            assert r.flag & 4
            continue
        i = int(r.read_name[1:])
        first = bool(r.flag & 64)
        assert (r.start0, bool(r.flag & 16), r.tlen) == (i * 7 if first else i * 7 + 60, not first, 100 if first else -100)
        assert r.flag & 2 and r.sequence == genome[r.start0:r.start0 + 40] and r.mapq == 60


def test_adapter_trimming(spark):
    ad, rev = "AGATCGGAAG", "TTTTCCCCGG"
    body = REF[:38]
    rows = [("full", body + ad, "I" * 48, body + rev, "I" * 48), ("part", body + ad[:4], "I" * 42, body, "I" * 38),
            ("two", body + ad[:2], "I" * 40, body, "I" * 38), ("short", REF[:30] + ad, "I" * 40, body, "I" * 38),
            ("error", body + "AGATCGCAAG", "I" * 48, body, "I" * 38)]
    df = spark.createDataFrame(rows, "name string, seq1 string, qual1 string, seq2 string, qual2 string")
    exact = {r.name: r for r in align.adapter_trim(df, ad, rev).collect()}
    assert set(exact) == {"full", "part", "two", "error"}
    assert exact["full"].seq1 == body and exact["full"].seq2 == body and len(exact["full"].qual1) == 38
    assert exact["part"].seq1 == body and exact["two"].seq1 == body + ad[:2] and len(exact["error"].seq1) == 48
    tolerant = {r.name: r for r in align.adapter_trim(df, ad, rev, error_rate=0.1).collect()}
    assert tolerant["error"].seq1 == body and tolerant["full"].seq1 == body and set(tolerant) == set(exact)
    with pytest.raises(ValueError):
        align.adapter_trim(df, ad)


def test_filters(spark):
    rows = [dict(read_name="many", flag=0 if i == 0 else 256, start0=i) for i in range(21)] + [dict(read_name="few")]
    df = reads_df(spark, rows)
    assert {r.read_name for r in filters.multimap_filter(df).collect()} == {"few"}
    nm = reads_df(spark, [dict(read_name="a", sequence="A" * 50), dict(read_name="b", sequence="A" * 50)]).withColumn(
        "nm", F.when(F.col("read_name") == "a", 2).otherwise(3))
    assert {r.read_name for r in filters.mismatch_filter(nm).collect()} == {"a"}
    gaps = reads_df(spark, [dict(read_name="tiny", cigar="5M10N5M"), dict(read_name="fine", cigar="5M20N5M"),
                            dict(read_name="far", mate_contig="chr1", mate_start0=2_000_000)])
    assert {r.read_name for r in filters.intron_mate_filter(gaps).collect()} == {"fine"}
    spliced = reads_df(spark, [dict(read_name="novel", cigar="3M20N7M"), dict(read_name="known", start0=50, cigar="3M20N7M"), dict(read_name="plain")])
    known = spark.createDataFrame([("chr1", 53, 73, "+")], "contig string, start0 bigint, end0 bigint, strand string")
    assert {r.read_name for r in filters.overhang_filter(spliced, known).collect()} == {"known", "plain"}
    assert {r.read_name for r in filters.by_junction_filter(spliced, known).collect()} == {"known", "plain"}
    pieces = reads_df(spark, [dict(read_name="s", cigar="4M6S"), dict(read_name="s", flag=2048, start0=90, cigar="4S6M")])
    assert as_set(filters.split_as_secondary(pieces), "start0", "flag") == {(0, 256), (90, 0)}
    table = rna.splice_junctions(spliced, known).collect()
    assert {(r.start0, r.end0, r.strand, r.annotated, r.unique_reads, r.max_overhang) for r in table} == {
        (3, 23, ".", False, 1, 3), (53, 73, "+", True, 1, 3)}


def test_reads_back_to_fragments_and_unmapped_kept(spark):
    df = reads_df(spark, [dict(read_name="a", flag=99, sequence="AACCGGTTAC", qualities="ABCDEFGHIJ"),
                          dict(read_name="a", flag=147, sequence="AACCGGTTAC", qualities="ABCDEFGHIJ"),
                          dict(read_name="a", flag=147 + 256, sequence="TTTTTTTTTT")])
    back = filters.revert_reads(df).collect()
    assert [tuple(r) for r in back] == [("a", "AACCGGTTAC", "ABCDEFGHIJ", "GTAACCGGTT", "JIHGFEDCBA")]
    kept = filters.keep_unmapped(df.where("flag = 99"), filters.revert_reads(df))
    assert as_set(kept, "flag", "sequence") == {(99, "AACCGGTTAC"), (141, "GTAACCGGTT")}


def test_transcripts_on_both_strands(spark):
    exons = spark.createDataFrame([("p", "chr1", 0, 10, "+"), ("p", "chr1", 30, 50, "+"), ("m", "chr1", 0, 10, "-"), ("m", "chr1", 30, 50, "-")],
                                  "transcript string, contig string, start0 bigint, end0 bigint, strand string")
    df = reads_df(spark, [dict(read_name="ok", start0=4, cigar="6M20N4M"), dict(read_name="off", start0=4, cigar="5M21N5M"),
                          dict(read_name="in", start0=35, cigar="10M")])
    got = as_set(rna.project_to_transcripts(df, exons), "read_name", "transcript", "tx_start0", "tx_end0")
    assert got == {("ok", "p", 4, 14), ("ok", "m", 16, 26), ("in", "p", 15, 25), ("in", "m", 5, 15)}


def test_read_groups(spark):
    df = reads_df(spark, [dict(read_name="a", read_group="x"), dict(read_name="b", read_group="y")])
    line = "@RG\\tID:x\\tLB:l1\\tSM:s1\\n@RG\\tID:z\\tLB:l2\\tSM:s2"
    assert as_set(align.assign_read_group(df, line), "read_name", "read_group", "library", "sample") == {
        ("a", "x", "l1", "s1"), ("b", "x", "l1", "s1")}
    made = align.assign_read_group(df, uuid="u", library="l", platform="p", unit="1").first()
    assert (made.read_group, made["sample"], made.library, made.platform) == ("u", "u", "l", "p")
    assert align.assign_read_group(df, library="l") is df


def test_sequence_dictionary_and_bins(spark):
    import hashlib
    d = metrics.sequence_dictionary(ref_df(spark).unionByName(ref_df(spark, "acgt", 10, "chr2"))).collect()
    assert {(r.contig, r.length, r.md5) for r in d} == {("chr1", 40, hashlib.md5(REF.encode()).hexdigest()),
                                                        ("chr2", 4, hashlib.md5(b"ACGT").hexdigest())}
    row = spark.sql("select 16383 as start0, 16385 as end0").select(metrics.sam_bin().alias("b")).first()
    assert row.b == 585 and metrics.bins_of_region(0, 1) == [0, 1, 9, 73, 585, 4681]
