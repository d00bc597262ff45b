"""DuckDB text for each registered query, written from the definitions rather than from the Spark plans."""
from __future__ import annotations

from checks.fixtures import ADAPTER_FWD, ADAPTER_REV, with_tables

ORACLE: dict[str, str] = {}

_READ = ("read_name, flag, contig, start0, end0, mapq, cigar, mate_contig, mate_start0, tlen, sequence, qualities, "
         "read_group, library, sample")
_KEY = "read_name, flag, contig, start0, cigar"
_MATE = "(flag & 192)"


def _add(name: str, body: str, *tables: str) -> None:
    ORACLE[name] = with_tables(body, *tables)


def _ops(source: str) -> str:
    """CTEs toks and ops: one row per CIGAR operation with the positions it starts at."""
    return f"""
toks AS (SELECT *, unnest(regexp_extract_all(cigar, '[0-9]+[MIDNSHP=X]')) AS tok,
                generate_subscripts(regexp_extract_all(cigar, '[0-9]+[MIDNSHP=X]'), 1) AS i
         FROM {source} WHERE flag & 4 = 0),
cut AS (SELECT *, CAST(substr(tok, 1, length(tok) - 1) AS BIGINT) AS len, right(tok, 1) AS op FROM toks),
ops AS (SELECT *, start0 + CAST(coalesce(sum(CASE WHEN op IN ('M', 'D', 'N', '=', 'X') THEN len ELSE 0 END) OVER w, 0) AS BIGINT) AS ref_at,
               CAST(coalesce(sum(CASE WHEN op IN ('M', 'I', 'S', '=', 'X') THEN len ELSE 0 END) OVER w, 0) AS BIGINT) AS read_at
        FROM cut WINDOW w AS (PARTITION BY {_KEY} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


_BASES = """
spread AS (SELECT *, unnest(range(len)) AS k FROM ops WHERE op = 'M'),
bases AS (SELECT s.*, ref_at + k AS pos0, read_at + k AS spot, substr(sequence, read_at + k + 1, 1) AS base,
                 ascii(substr(qualities, read_at + k + 1, 1)) - 33 AS quality,
                 substr(seq, (ref_at + k) % 96 + 1, 1) AS ref_base
          FROM spread s JOIN ref_blocks b ON b.contig = s.contig AND b.block = (ref_at + k) // 96)"""

_NM = f"""
wrong AS (SELECT {_KEY}, CAST(count(*) FILTER (base <> ref_base) AS BIGINT) AS wrong FROM bases GROUP BY ALL),
gaps AS (SELECT {_KEY}, CAST(coalesce(sum(len) FILTER (op IN ('I', 'D')), 0) AS BIGINT) AS gap FROM ops GROUP BY ALL),
nms AS (SELECT {_KEY}, wrong + gap AS nm FROM wrong JOIN gaps USING ({_KEY}))"""

# ---- sources and sinks ---------------------------------------------------------------------------------------

_add("scan_sam", f"SELECT {_READ} FROM reads", "reads")
_add("reads_to_columnar", f"SELECT {_READ}, flag & 4 = 0 AS mapped FROM reads", "reads")
_add("scan_vcf", """SELECT contig, start0, end0, ref, alt, id, CAST(50 AS DOUBLE) AS qual
FROM (SELECT * FROM known_sites UNION ALL SELECT * FROM known_indels)""", "known_sites", "known_indels")
for _name in ("scan_fastq", "write_fastq"):
    _add(_name, "SELECT name, seq1, qual1, seq2, qual2 FROM fragments", "fragments")
_add("scan_fasta", """WITH whole AS (SELECT contig, string_agg(seq, '' ORDER BY block) AS s FROM ref_blocks GROUP BY contig),
cut AS (SELECT *, unnest(range((length(s) + 999) // 1000)) AS block FROM whole)
SELECT contig, block, substr(s, block * 1000 + 1, 1000) AS seq FROM cut""", "ref_blocks")
_add("fasta_index", """WITH sizes AS (SELECT contig, CAST(sum(length(seq)) AS BIGINT) AS length, count(*) AS n FROM ref_blocks GROUP BY contig)
SELECT contig, length, CAST(6 + coalesce(sum(6 + n * 97) OVER (ORDER BY contig ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
       CAST(96 AS INT) AS line_bases, CAST(97 AS INT) AS line_width FROM sizes""", "ref_blocks")
_add("scan_bed", "SELECT contig, start0, end0, name, score, strand FROM targets", "targets")
_add("scan_gtf", """SELECT contig, start0, end0, name, score, strand, source, type, concat('g', name) AS gene_id, '2' AS level
FROM targets""", "targets")
_add("scan_gff3", """SELECT contig, start0, end0, name, score, strand, source, type, concat('a;b ', source) AS note
FROM targets""", "targets")
_add("scan_interval_list", "SELECT contig, start0, end0, name, strand FROM targets", "targets")
_add("scan_narrowpeak", """SELECT contig, start0, end0, name, score, strand, score AS signal, CAST(25 AS INT) AS peak
FROM targets""", "targets")
_add("scan_features_parquet", "SELECT contig, start0, end0, name, score, strand, source, type FROM targets", "targets")
_add("scan_manifest", f"SELECT {_KEY}, sample FROM reads", "reads")
_add("stringency_lenient", "SELECT contig, start0, end0, name FROM targets WHERE score <= 40", "targets")
_add("stringency_silent", f"SELECT {_KEY} FROM reads WHERE flag & 4 = 0", "reads")
_SAM_LINE = r"""concat_ws(chr(9), read_name, CAST(flag AS VARCHAR), coalesce(contig, '*'), CAST(coalesce(start0 + 1, 0) AS VARCHAR),
    CAST(mapq AS VARCHAR), cigar, CASE WHEN mate_contig IS NULL THEN '*' WHEN mate_contig = contig THEN '=' ELSE mate_contig END,
    CAST(coalesce(mate_start0 + 1, 0) AS VARCHAR), CAST(tlen AS VARCHAR), sequence, qualities, concat('RG:Z:', read_group))"""
_add("write_sam", f"""SELECT {_SAM_LINE} AS line FROM reads
UNION ALL SELECT concat_ws(chr(9), '@HD', 'VN:1.6', 'SO:coordinate')
UNION ALL SELECT concat_ws(chr(9), '@SQ', concat('SN:', contig), concat('LN:', CAST(sum(length(seq)) AS BIGINT))) FROM ref_blocks GROUP BY contig
UNION ALL SELECT DISTINCT concat_ws(chr(9), '@RG', concat('ID:', read_group), concat('LB:', library), concat('SM:', sample)) FROM reads""",
     "reads", "ref_blocks")
_add("write_gff3", """SELECT concat_ws(chr(9), contig, source, type, CAST(start0 + 1 AS VARCHAR), CAST(end0 AS VARCHAR), CAST(score AS VARCHAR),
    strand, '.', concat('Name=', name, ';brand=', source, '%3Bx')) AS line FROM targets UNION ALL SELECT '##gff-version 3'""", "targets")

# ---- filters and projections ---------------------------------------------------------------------------------

_add("aligned_reads", f"SELECT {_KEY} FROM reads WHERE flag & 4 = 0", "reads")
_add("limit_projection", "SELECT read_name, flag, mapq FROM reads", "reads")
_add("flag_filter", f"SELECT {_KEY} FROM reads WHERE flag & 66 = 66 AND flag & 16 = 0", "reads")
_ALN = ("reads", "alignments")
_add("multimap_filter", f"""WITH loci AS (SELECT read_name, {_MATE} AS mate, count(*) FILTER (flag & 2052 = 0) AS n FROM alignments GROUP BY ALL)
SELECT {_KEY} FROM alignments a JOIN loci l USING (read_name) WHERE (a.flag & 192) = l.mate AND n <= 20""", *_ALN)
_add("mismatch_filter", f"""WITH {_ops("reads")}, {_BASES}, {_NM},
tagged AS (SELECT r.read_name, r.flag, nm, length(sequence) AS size FROM reads r JOIN nms USING ({_KEY})),
pairs AS (SELECT read_name, sum(nm) AS n, sum(size) AS s FROM tagged GROUP BY read_name)
SELECT read_name, flag, nm FROM tagged JOIN pairs USING (read_name) WHERE n <= 999 AND n <= s * 0.04""", "reads", "ref_blocks")
_add("intron_mate_filter", f"""SELECT {_KEY} FROM alignments
WHERE coalesce(mate_contig <> contig OR abs(mate_start0 - start0) <= 60, true)
  AND coalesce(list_bool_and(list_transform(regexp_extract_all(cigar, '([0-9]+)N', 1), lambda g: CAST(g AS BIGINT) BETWEEN 20 AND 1000000)), true)""", *_ALN)
# Overhang: aligned bases on each side of a gap, up to the neighbouring gap.
_GAPS = f"""
parts AS (SELECT *, coalesce(sum(CASE WHEN op = 'N' THEN 1 ELSE 0 END) OVER (PARTITION BY {_KEY} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM ops),
sides AS (SELECT {_KEY}, part, CAST(coalesce(sum(len) FILTER (op = 'M'), 0) AS BIGINT) AS m FROM parts GROUP BY ALL),
junc AS (SELECT p.read_name, p.flag, p.contig, p.start0, p.cigar, p.ref_at AS j0, p.ref_at + p.len AS j1, least(a.m, b.m) AS overhang
         FROM parts p JOIN sides a ON (p.read_name, p.flag, p.contig, p.start0, p.cigar, p.part) = (a.read_name, a.flag, a.contig, a.start0, a.cigar, a.part)
                      JOIN sides b ON (p.read_name, p.flag, p.contig, p.start0, p.cigar, p.part + 1) = (b.read_name, b.flag, b.contig, b.start0, b.cigar, b.part)
         WHERE p.op = 'N')"""
_add("overhang_filter", f"""WITH {_ops("alignments")}, {_GAPS},
bad AS (SELECT DISTINCT j.read_name, j.flag, j.contig, j.start0, j.cigar FROM junc j
        LEFT JOIN junctions k ON k.contig = j.contig AND k.start0 = j0 AND k.end0 = j1
        WHERE overhang < CASE WHEN k.contig IS NULL THEN 18 ELSE 1 END)
SELECT {_KEY} FROM alignments a WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE (a.read_name, a.flag, a.contig, a.start0, a.cigar) = (b.read_name, b.flag, b.contig, b.start0, b.cigar))""",
     *_ALN, "junctions")
_SJ = f"""
loci AS (SELECT read_name, {_MATE} AS mate, count(*) FILTER (flag & 2052 = 0) AS nh FROM alignments GROUP BY ALL),
sj AS (SELECT j.contig, j0 AS start0, j1 AS end0, count(*) FILTER (nh = 1) AS unique_reads, count(*) FILTER (nh > 1) AS multi_reads,
              CAST(max(overhang) AS INT) AS max_overhang
       FROM junc j JOIN loci l ON l.read_name = j.read_name AND l.mate = (j.flag & 192) GROUP BY ALL),
sjs AS (SELECT sj.*, coalesce(k.strand, '.') AS strand, k.contig IS NOT NULL AS annotated
        FROM sj LEFT JOIN junctions k ON k.contig = sj.contig AND k.start0 = sj.start0 AND k.end0 = sj.end0)"""
_add("by_junction_filter", f"""WITH {_ops("alignments")}, {_GAPS}, {_SJ},
bad AS (SELECT DISTINCT j.read_name, j.flag, j.contig, j.start0, j.cigar FROM junc j
        WHERE NOT EXISTS (SELECT 1 FROM sjs s WHERE s.contig = j.contig AND s.start0 = j0 AND s.end0 = j1 AND (annotated OR unique_reads > 1)))
SELECT {_KEY} FROM alignments a WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE (a.read_name, a.flag, a.contig, a.start0, a.cigar) = (b.read_name, b.flag, b.contig, b.start0, b.cigar))""",
     *_ALN, "junctions")
_add("splice_junctions", f"""WITH {_ops("alignments")}, {_GAPS}, {_SJ} SELECT * FROM sjs""", *_ALN, "junctions")
_add("keep_unmapped", f"""SELECT read_name, flag, contig, sequence, qualities FROM reads WHERE flag & 4 = 0
UNION ALL SELECT read_name, CASE WHEN flag & 64 = 64 THEN 77 ELSE 141 END AS flag, NULL AS contig,
    CASE WHEN flag & 16 = 16 THEN reverse(translate(sequence, 'ACGT', 'TGCA')) ELSE sequence END AS sequence,
    CASE WHEN flag & 16 = 16 THEN reverse(qualities) ELSE qualities END AS qualities FROM reads WHERE flag & 4 = 4""", "reads")
_add("attach_tags", f"""WITH {_ops("alignments")}, {_BASES}, {_NM},
counted AS (SELECT {_KEY}, count(*) FILTER (flag & 2052 = 0) OVER (PARTITION BY read_name, flag & 192, flag & 4) AS nh,
            row_number() OVER (PARTITION BY read_name, flag & 192, flag & 4 ORDER BY flag & 2304, contig, start0, cigar, flag) AS hi
            FROM alignments)
SELECT a.read_name, a.flag, a.contig, a.start0, a.cigar, CASE WHEN a.flag & 4 = 0 THEN nh END AS nh, CASE WHEN a.flag & 4 = 0 THEN hi END AS hi, nm
FROM counted a LEFT JOIN nms n ON (a.read_name, a.flag, a.contig, a.start0, a.cigar) = (n.read_name, n.flag, n.contig, n.start0, n.cigar)""",
     *_ALN, "ref_blocks")
_add("split_as_secondary", f"""WITH sized AS (SELECT *, flag & 260 = 0 AS piece,
    coalesce(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)M', 1), lambda g: CAST(g AS BIGINT))), 0) AS size FROM alignments),
ranked AS (SELECT *, row_number() OVER (PARTITION BY read_name, flag & 192, piece ORDER BY size DESC, flag & 2048, contig, start0) AS r FROM sized)
SELECT read_name, CAST(CASE WHEN NOT piece THEN flag WHEN r = 1 THEN flag & ~2048 ELSE (flag & ~2048) | 256 END AS INT) AS flag, contig, start0, cigar
FROM ranked""", *_ALN)
_add("assign_read_group", """SELECT read_name, flag, CASE WHEN read_group IN ('rg1', 'rg2') THEN read_group ELSE 'rg1' END AS read_group,
    CASE WHEN read_group = 'rg2' THEN 'libB' ELSE 'libA' END AS library, CASE WHEN read_group = 'rg2' THEN 'B' ELSE 'A' END AS sample,
    'ILLUMINA' AS platform FROM reads""", "reads")


def _kept(seq: str, adapter: str) -> str:
    ends = " ".join(f"WHEN right({seq}, {n}) = '{adapter[:n]}' THEN length({seq}) - {n}" for n in range(len(adapter) - 1, 2, -1))
    return f"CASE WHEN strpos({seq}, '{adapter}') > 0 THEN strpos({seq}, '{adapter}') - 1 {ends} ELSE length({seq}) END"


_TRIM = f"""trimmed AS (SELECT name, substr(seq1, 1, n1) AS seq1, substr(qual1, 1, n1) AS qual1, substr(seq2, 1, n2) AS seq2, substr(qual2, 1, n2) AS qual2
FROM (SELECT *, {_kept("seq1", ADAPTER_FWD)} AS n1, {_kept("seq2", ADAPTER_REV)} AS n2 FROM fragments) WHERE n1 >= 35 AND n2 >= 35)"""
_add("adapter_trim", f"WITH {_TRIM} SELECT * FROM trimmed", "fragments")
_add("revert_reads", f"""WITH raw AS (SELECT read_name AS name, flag & 128 = 128 AS second,
    CASE WHEN flag & 16 = 16 THEN reverse(translate(sequence, 'ACGT', 'TGCA')) ELSE sequence END AS s,
    CASE WHEN flag & 16 = 16 THEN reverse(qualities) ELSE qualities END AS q FROM alignments WHERE flag & 2304 = 0)
SELECT name, max(s) FILTER (NOT second) AS seq1, max(q) FILTER (NOT second) AS qual1, max(s) FILTER (second) AS seq2, max(q) FILTER (second) AS qual2
FROM raw GROUP BY name""", *_ALN)

# ---- sorts ---------------------------------------------------------------------------------------------------

_add("sort_coordinate", """SELECT read_name, flag, row_number() OVER (ORDER BY contig ASC NULLS LAST, start0 ASC NULLS LAST, flag & 16, read_name, flag) AS rank
FROM reads""", "reads")
_add("sort_queryname", "SELECT read_name, flag, row_number() OVER (ORDER BY read_name, flag & 192, flag) AS rank FROM reads", "reads")
_add("sort_variants", """SELECT contig, start0, id, row_number() OVER (ORDER BY contig, start0, end0, ref, alt, id) AS rank
FROM (SELECT * FROM known_sites UNION ALL SELECT * FROM known_indels)""", "known_sites", "known_indels")

# ---- joins and sets ------------------------------------------------------------------------------------------

_add("overlap_join", """SELECT read_name, flag, t.name, least(r.end0, t.end0) - greatest(r.start0, t.start0) AS bases
FROM reads r JOIN targets t ON r.contig = t.contig AND r.start0 < t.end0 AND t.start0 < r.end0""", "reads", "targets")
_add("overlap_join_left", """SELECT read_name, flag, t.name
FROM reads r LEFT JOIN targets t ON r.contig = t.contig AND r.start0 < t.end0 AND t.start0 < r.end0 WHERE r.flag & 4 = 0""", "reads", "targets")
_HIT = "EXISTS (SELECT 1 FROM known_sites s WHERE r.contig = s.contig AND r.start0 < s.end0 AND s.start0 < r.end0)"
_add("overlap_join_semi", f"SELECT {_KEY} FROM reads r WHERE flag & 4 = 0 AND {_HIT}", "reads", "known_sites")
_add("overlap_join_anti", f"SELECT {_KEY} FROM reads r WHERE flag & 4 = 0 AND NOT {_HIT}", "reads", "known_sites")
_add("known_site_mask", f"""WITH {_ops("reads")}, {_BASES}
SELECT contig, pos0 // 100 AS stretch, count(*) AS bases, count(*) FILTER (base <> ref_base) AS mismatches
FROM bases b WHERE NOT EXISTS (SELECT 1 FROM known_sites s WHERE s.contig = b.contig AND s.start0 = b.pos0) GROUP BY ALL""",
     "reads", "ref_blocks", "known_sites")
_add("reads_in_targets", f"""WITH rb AS (SELECT *, unnest(range(start0 // 256, (end0 - 1) // 256 + 1)) AS bin FROM reads WHERE flag & 4 = 0),
tb AS (SELECT *, unnest(range(start0 // 256, (end0 - 1) // 256 + 1)) AS bin FROM targets),
pairs AS (SELECT {", ".join("r." + c for c in _KEY.split(", "))}, t.start0 AS s, t.end0 AS e,
    row_number() OVER (PARTITION BY r.read_name, r.flag ORDER BY least(r.end0, t.end0) - greatest(r.start0, t.start0) DESC, t.start0, t.end0) AS n
    FROM rb r JOIN tb t ON r.contig = t.contig AND r.bin = t.bin AND r.start0 < t.end0 AND t.start0 < r.end0 AND r.bin = greatest(r.start0, t.start0) // 256)
SELECT r.read_name, r.flag, p.s AS target_start0, p.e AS target_end0
FROM reads r LEFT JOIN pairs p ON p.read_name = r.read_name AND p.flag = r.flag AND p.n = 1""", "reads", "targets")
_add("project_to_transcripts", f"""WITH {_ops("alignments")},
parts AS (SELECT *, coalesce(sum(CASE WHEN op = 'N' THEN 1 ELSE 0 END) OVER (PARTITION BY {_KEY} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part FROM ops),
blocks AS (SELECT {_KEY}, part, min(ref_at) AS b0, max(CASE WHEN op IN ('M', 'D') THEN ref_at + len ELSE ref_at END) AS b1 FROM parts WHERE op <> 'N' GROUP BY ALL),
counted AS (SELECT *, count(*) OVER (PARTITION BY {_KEY}) AS n FROM blocks),
ex AS (SELECT *, row_number() OVER w AS exon, CAST(sum(end0 - start0) OVER w AS BIGINT) - (end0 - start0) AS off,
              CAST(sum(end0 - start0) OVER (PARTITION BY transcript) AS BIGINT) AS size FROM exons WINDOW w AS (PARTITION BY transcript ORDER BY start0)),
hits AS (SELECT c.*, e.transcript, e.strand, e.size, e.exon, e.off + b0 - e.start0 AS spot FROM counted c JOIN ex e ON e.contig = c.contig AND e.start0 <= b0 AND b1 <= e.end0
         WHERE (part = 0 OR b0 = e.start0) AND (part = n - 1 OR b1 = e.end0)),
whole AS (SELECT {_KEY}, transcript, strand, size, min(spot) AS a, CAST(sum(b1 - b0) AS BIGINT) AS span FROM hits GROUP BY {_KEY}, transcript, strand, size, n
          HAVING count(*) = n AND max(exon) - min(exon) = n - 1)
SELECT read_name, flag, start0, cigar, transcript, CASE WHEN strand = '+' THEN a ELSE size - a - span END AS tx_start0,
       CASE WHEN strand = '+' THEN a + span ELSE size - a END AS tx_end0, (flag & 16 = 16) = (strand = '+') AS antisense FROM whole""",
     *_ALN, "exons")
_add("mate_join", """SELECT read_name, max(start0) FILTER (flag & 64 = 64) AS start_1, max(start0) FILTER (flag & 128 = 128) AS start_2,
    max(flag) FILTER (flag & 64 = 64) AS flag_1, max(flag) FILTER (flag & 128 = 128) AS flag_2, true AS mated
FROM alignments WHERE flag & 2304 = 0 GROUP BY read_name HAVING count(*) FILTER (flag & 64 = 64) = 1 AND count(*) FILTER (flag & 128 = 128) = 1""", *_ALN)
_add("union_known_sites", """SELECT contig, start0, end0 FROM known_sites UNION SELECT contig, start0, end0 FROM known_indels""",
     "known_sites", "known_indels")
_add("union_samples", f"SELECT CASE WHEN flag & 64 = 64 THEN 'first' ELSE 'second' END AS sample, {_KEY} FROM reads", "reads")

# ---- aggregations --------------------------------------------------------------------------------------------

_add("mean_insert_size", """SELECT CAST(coalesce(floor(avg(abs(tlen))), 150) AS BIGINT) AS mean_insert_size FROM reads
WHERE flag & 66 = 66 AND abs(tlen) < 10000""", "reads")
_add("sequence_dictionary", """SELECT contig, CAST(sum(length(seq)) AS BIGINT) AS length, md5(string_agg(upper(seq), '' ORDER BY block)) AS md5
FROM ref_blocks GROUP BY contig""", "ref_blocks")
_add("genomic_bin_index", """SELECT contig, CAST(CASE WHEN start0 >> 14 = (end0 - 1) >> 14 THEN 4681 + (start0 >> 14)
    WHEN start0 >> 17 = (end0 - 1) >> 17 THEN 585 + (start0 >> 17) WHEN start0 >> 20 = (end0 - 1) >> 20 THEN 73 + (start0 >> 20)
    WHEN start0 >> 23 = (end0 - 1) >> 23 THEN 9 + (start0 >> 23) WHEN start0 >> 26 = (end0 - 1) >> 26 THEN 1 + (start0 >> 26) ELSE 0 END AS BIGINT) AS bin,
    start0 >> 14 AS "window", count(*) AS n_reads, min(start0) AS min_start0 FROM reads WHERE flag & 4 = 0 GROUP BY ALL""", "reads")
_add("region_lookup", f"SELECT {_KEY} FROM reads WHERE contig = 'chr2' AND start0 < 90000 AND end0 > 1000", "reads")
_DEPTH = """depth AS (SELECT s.sample, t.name AS target, t.contig, t.start0, t.end0,
    CAST(coalesce(sum(least(r.end0, t.end0) - greatest(r.start0, t.start0)) FILTER (r.start0 IS NOT NULL), 0) AS BIGINT) AS bases
    FROM (SELECT DISTINCT sample FROM reads) s CROSS JOIN targets t
    LEFT JOIN reads r ON r.sample = s.sample AND r.contig = t.contig AND r.start0 < t.end0 AND t.start0 < r.end0 GROUP BY ALL),
cover AS (SELECT *, bases / (end0 - start0) AS mean_depth FROM depth)"""
_add("target_coverage", f"WITH {_DEPTH} SELECT * REPLACE (round(mean_depth, 6) AS mean_depth) FROM cover", "reads", "targets")
_SIGNAL = """steps AS (SELECT contig, pos0, CAST(sum(d) AS BIGINT) AS d FROM (SELECT contig, ref_at AS pos0, 1 AS d FROM ops WHERE op = 'M'
    UNION ALL SELECT contig, ref_at + len, -1 FROM ops WHERE op = 'M') GROUP BY ALL HAVING sum(d) <> 0),
runs AS (SELECT contig, pos0 AS start0, lead(pos0) OVER w AS end0, CAST(sum(d) OVER w AS BIGINT) AS depth FROM steps WINDOW w AS (PARTITION BY contig ORDER BY pos0))"""
_add("coverage_signal", f"WITH {_ops('reads')}, {_SIGNAL} SELECT * FROM runs WHERE depth > 0", "reads")
_add("write_bedgraph", f"""WITH {_ops('reads')}, {_SIGNAL}
SELECT concat_ws(chr(9), contig, CAST(start0 AS VARCHAR), CAST(end0 AS VARCHAR), CAST(depth AS VARCHAR)) AS line FROM runs WHERE depth > 0""", "reads")
_add("alignment_summary", f"""WITH per AS (SELECT read_name, {_MATE} AS mate, count(*) FILTER (flag & 2052 = 0) AS loci,
    max(CASE WHEN flag & 2304 = 0 THEN length(sequence) END) AS size,
    sum(CASE WHEN flag & 2304 = 0 THEN length(cigar) - length(replace(cigar, 'N', '')) END) AS splices FROM alignments GROUP BY ALL)
SELECT count(*) AS input_reads, count(*) FILTER (loci = 1) AS unique_reads, count(*) FILTER (loci > 1 AND loci <= 20) AS multi_reads,
       count(*) FILTER (loci > 20) AS too_many_loci, count(*) FILTER (loci = 0) AS unmapped_reads, round(avg(size), 6) AS mean_length,
       CAST(sum(splices) AS BIGINT) AS splices FROM per""", *_ALN)


# ---- duplicates ----------------------------------------------------------------------------------------------

def _frags(source: str) -> str:
    """Fragments with their two outermost ends as text keys, score, mapping quality and number of reads."""
    return f"""
usable AS (SELECT *, lpad(CAST(CASE WHEN flag & 16 = 16 THEN end0 - 1 + coalesce(TRY_CAST(regexp_extract(cigar, '([0-9]+)S$', 1) AS BIGINT), 0)
                ELSE start0 - coalesce(TRY_CAST(regexp_extract(cigar, '^([0-9]+)S', 1) AS BIGINT), 0) END + 1000 AS VARCHAR), 12, '0') AS p5,
            CAST(list_sum(list_transform(string_split(qualities, ''), lambda c: CASE WHEN ascii(c) >= 48 THEN ascii(c) - 33 ELSE 0 END)) AS BIGINT) AS q15
          FROM {source} WHERE flag & 2308 = 0),
ends AS (SELECT *, concat(contig, '|', p5, '|', CAST(flag & 16 AS VARCHAR)) AS e FROM usable),
frags AS (SELECT library, read_name, min(e) AS e1, max(e) AS e2, count(*) AS n, sum(q15) AS score, sum(mapq) AS mq FROM ends GROUP BY ALL)"""


_KEEP = """
pair_rank AS (SELECT library, read_name, row_number() OVER (PARTITION BY library, e1, e2 ORDER BY score DESC, read_name) AS r FROM frags WHERE n > 1),
pair_ends AS (SELECT library, e1 AS e FROM frags WHERE n > 1 UNION SELECT library, e2 FROM frags WHERE n > 1),
lone_rank AS (SELECT library, read_name, row_number() OVER (PARTITION BY library, e1 ORDER BY score DESC, read_name) AS r FROM frags f
              WHERE n = 1 AND NOT EXISTS (SELECT 1 FROM pair_ends p WHERE p.library = f.library AND p.e = f.e1)),
keepers AS (SELECT library, read_name FROM pair_rank WHERE r = 1 UNION ALL SELECT library, read_name FROM lone_rank WHERE r = 1)"""
_MARK = """marked AS (SELECT s.* REPLACE (CAST(CASE WHEN flag & 2308 <> 0 OR EXISTS (SELECT 1 FROM keepers k WHERE k.library = s.library AND k.read_name = s.read_name)
    THEN flag ELSE flag | 1024 END AS INT) AS flag) FROM {0} s)"""
_add("mark_duplicates", f"WITH {_frags('reads')}, {_KEEP}, {_MARK.format('reads')} SELECT {_KEY} FROM marked", "reads")
_add("mark_duplicates_alignments", f"WITH {_frags('alignments')}, {_KEEP}, {_MARK.format('alignments')} SELECT {_KEY} FROM marked", *_ALN)
_add("duplicate_metrics", f"""WITH {_frags('reads')}, {_KEEP}, {_MARK.format('reads')},
counts AS (SELECT library, count(*) FILTER (flag & 4 = 0 AND flag & 8 = 8) AS unpaired_examined, count(*) FILTER (flag & 12 = 0) AS p,
    count(*) FILTER (flag & 4 = 4) AS unmapped, count(*) FILTER (flag & 12 = 8 AND flag & 1024 = 1024) AS unpaired_duplicates,
    count(*) FILTER (flag & 12 = 0 AND flag & 1024 = 1024) AS d FROM marked GROUP BY library)
SELECT library, unpaired_examined, p // 2 AS pairs_examined, unmapped, unpaired_duplicates, d // 2 AS pair_duplicates,
       round((unpaired_duplicates + d) / (unpaired_examined + p), 6) AS fraction_duplicate FROM counts""", "reads")
_add("remove_duplicates", f"""WITH {_frags('reads')},
pair_rank AS (SELECT library, read_name, row_number() OVER (PARTITION BY library, e1, e2 ORDER BY mq DESC, read_name) AS r FROM frags WHERE n > 1)
SELECT {_KEY} FROM reads s WHERE NOT EXISTS (SELECT 1 FROM pair_rank p WHERE r > 1 AND p.library = s.library AND p.read_name = s.read_name)""", "reads")
_add("mark_duplicates_by_name", f"""WITH {_frags('reads')},
pair_rank AS (SELECT library, read_name, row_number() OVER (PARTITION BY library, e1, e2 ORDER BY read_name) AS r FROM frags WHERE n > 1)
SELECT read_name, CAST(CASE WHEN flag & 2308 = 0 AND EXISTS (SELECT 1 FROM pair_rank p WHERE r > 1 AND p.library = s.library AND p.read_name = s.read_name)
    THEN flag | 1024 ELSE flag END AS INT) AS flag, contig, start0, cigar FROM reads s""", "reads")

# ---- realignment targets -------------------------------------------------------------------------------------

_ISLES = """
spans AS (SELECT contig, greatest(ref_at - 10, 0) AS a, ref_at + CASE WHEN op = 'D' THEN len ELSE 1 END + 10 AS b FROM ops WHERE op IN ('I', 'D')
          UNION SELECT contig, greatest(start0 - 10, 0), end0 + 10 FROM known_indels),
marks AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY contig ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM spans),
isles AS (SELECT *, sum(fresh) OVER (PARTITION BY contig ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM marks),
merged AS (SELECT contig, min(a) AS start0, max(b) AS end0 FROM isles GROUP BY contig, g)"""
_add("realignment_targets", f"""WITH {_ops("reads")}, {_ISLES} SELECT * FROM merged""", "reads", "known_indels")

# Gains of the candidate indels: each read of a target against each candidate of that target near it, at all near places.
_GENOME = "genome AS MATERIALIZED (SELECT contig, string_agg(seq, '' ORDER BY block) AS letters FROM ref_blocks GROUP BY contig)"
_GAINS = f"""
plain AS (SELECT DISTINCT {_KEY}, end0, sequence, qualities, read_group, sample FROM reads
          WHERE flag & 3844 = 0 AND regexp_full_match(cigar, '([0-9]+[MID])+') AND length(sequence) = length(qualities)),
near AS (SELECT r.*, concat(t.contig, ':', t.start0, ':', t.end0) AS target, t.start0 AS t0, t.end0 AS t1,
            row_number() OVER (PARTITION BY {", ".join("r." + c for c in _KEY.split(", "))}, sequence, qualities, read_group, sample
                               ORDER BY least(r.end0, t.end0) - greatest(r.start0, t.start0) DESC, t.start0, t.end0) AS n
         FROM plain r JOIN merged t ON r.contig = t.contig AND r.start0 < t.end0 AND t.start0 < r.end0),
placed AS MATERIALIZED (SELECT *, row_number() OVER () AS rid, coalesce(list_sum(list_transform(regexp_extract_all(cigar, '([0-9]+)[ID]', 1), lambda g: CAST(g AS BIGINT))), 0)::BIGINT AS own
           FROM near WHERE n = 1),
gaps AS (SELECT {_KEY}, sequence, ref_at, read_at, len, op, count(*) FILTER (op IN ('I', 'D')) OVER (PARTITION BY {_KEY}, sequence) AS many FROM ops),
cands AS MATERIALIZED (
    SELECT DISTINCT p.target, p.contig, ref_at AS pos, CASE WHEN op = 'D' THEN len ELSE 0 END AS del_len,
           CASE WHEN op = 'I' THEN substr(p.sequence, read_at + 1, len) ELSE '' END AS ins
    FROM placed p JOIN gaps g ON (p.read_name, p.flag, p.contig, p.start0, p.cigar, p.sequence) = (g.read_name, g.flag, g.contig, g.start0, g.cigar, g.sequence)
    WHERE g.op IN ('I', 'D') AND many = 1
    UNION
    SELECT DISTINCT p.target, p.contig, k.start0 + 1, length(ref) - 1, substr(alt, 2)
    FROM (SELECT DISTINCT target, contig, t0, t1 FROM placed) p JOIN known_indels k ON k.contig = p.contig AND k.start0 < p.t1 AND p.t0 < k.end0
    WHERE substr(ref, 1, 1) = substr(alt, 1, 1) AND (length(ref) > 1) <> (length(alt) > 1)),
pairs AS (SELECT p.*, c.pos, c.del_len, c.ins, del_len + length(ins) AS size FROM placed p JOIN cands c USING (target)
          WHERE p.start0 < pos + del_len + del_len + length(ins) + 10 AND pos - del_len - length(ins) - 10 < p.end0),
spanned AS (SELECT *, greatest(0, least(start0 - size - own - 10, pos)) AS lo, greatest(end0 + size + own + 10, pos + del_len) AS hi FROM pairs),
shaped AS (SELECT c.* EXCLUDE (contig), contig, concat(substr(letters, lo + 1, pos - lo), ins, substr(letters, pos + del_len + 1, hi - pos - del_len)) AS hap FROM spanned c JOIN genome USING (contig)),
now AS MATERIALIZED (SELECT p.rid, coalesce(sum(CASE WHEN base <> ref_base THEN quality END), 0) AS current
        FROM placed p LEFT JOIN bases b ON (p.read_name, p.flag, p.contig, p.start0, p.cigar, p.sequence) = (b.read_name, b.flag, b.contig, b.start0, b.cigar, b.sequence) GROUP BY p.rid),
costs AS (SELECT rid, target, pos, del_len, ins, lo, length(sequence) AS n, list_transform(range(0, length(hap) - length(sequence) + 1), lambda p: list_sum(list_transform(
               range(1, length(sequence) + 1), lambda i: CASE WHEN substr(hap, p + i, 1) <> substr(sequence, i, 1) THEN ascii(substr(qualities, i, 1)) - 33 ELSE 0 END))) AS costs
          FROM shaped),
tried AS MATERIALIZED (SELECT * EXCLUDE (costs), list_min(costs) AS score, list_position(costs, list_min(costs)) - 1 AS a FROM costs),
gains AS (SELECT target, pos, del_len, ins, count(*) AS reads, count(*) FILTER (score < current) AS better,
              CAST(sum(greatest(current - score, 0)) AS BIGINT) AS gain FROM tried JOIN now USING (rid) GROUP BY target, pos, del_len, ins)"""
_add("realign_gains", f"""WITH {_ops("reads")}, {_BASES}, {_ISLES}, {_GENOME}, {_GAINS} SELECT * FROM gains""", "reads", "known_indels", "ref_blocks")


def _realigned(lod: float) -> str:
    """Reads with those moved that fit the accepted candidate of their target better."""
    return f"""{_ops("reads")}, {_BASES}, {_ISLES}, {_GENOME}, {_GAINS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY gain DESC, pos, del_len, ins) AS r FROM gains WHERE gain >= {10 * lod}),
moving AS (SELECT t.*, t.pos - lo AS x, length(t.ins) AS added FROM tried t JOIN now USING (rid) JOIN ranked k
           ON k.r = 1 AND (k.target, k.pos, k.del_len, k.ins) = (t.target, t.pos, t.del_len, t.ins) WHERE score < current),
fresh AS (SELECT rid, lo + CASE WHEN a + n <= x THEN a WHEN del_len > 0 THEN CASE WHEN a >= x THEN a + del_len ELSE a END
                                WHEN a >= x + added THEN a - added WHEN a < x THEN a ELSE x END AS start0,
       CASE WHEN a + n <= x OR (del_len > 0 AND a >= x) OR (del_len = 0 AND a >= x + added) THEN concat(n, 'M')
            WHEN del_len > 0 THEN concat(x - a, 'M', del_len, 'D', n - (x - a), 'M')
            WHEN a < x AND n - (x - a) > added THEN concat(x - a, 'M', added, 'I', n - (x - a) - added, 'M')
            WHEN a < x THEN concat(x - a, 'M', n - (x - a), 'S')
            WHEN x + added - a < n THEN concat(x + added - a, 'S', n - (x + added - a), 'M') END AS cigar FROM moving),
moved AS (SELECT p.*, f.start0 AS new_start0, f.cigar AS new_cigar,
              f.start0 + list_sum(list_transform(regexp_extract_all(f.cigar, '([0-9]+)[MD]', 1), lambda g: CAST(g AS BIGINT)))::BIGINT AS new_end0
          FROM placed p JOIN fresh f USING (rid) WHERE f.cigar IS NOT NULL),
realigned AS (SELECT r.* REPLACE (coalesce(new_start0, r.start0) AS start0, coalesce(new_end0, r.end0) AS end0, coalesce(new_cigar, r.cigar) AS cigar)
    FROM reads r LEFT JOIN moved m ON (r.read_name, r.flag, r.contig, r.start0, r.cigar, r.sequence, r.qualities, r.read_group, r.sample)
                                    = (m.read_name, m.flag, m.contig, m.start0, m.cigar, m.sequence, m.qualities, m.read_group, m.sample))"""


_add("realign_indels", f"WITH {_realigned(5.0)} SELECT {_KEY}, end0 FROM realigned", "reads", "known_indels", "ref_blocks")
_add("realign_indels_low_threshold", f"WITH {_realigned(0.3)} SELECT {_KEY}, end0 FROM realigned", "reads", "known_indels", "ref_blocks")


# ---- recalibration -------------------------------------------------------------------------------------------

def _recal(source: str, sites: str) -> str:
    return f"""
{_ops(source)}, {_BASES},
masked AS (SELECT * FROM bases b WHERE flag & 3844 = 0 AND NOT EXISTS (SELECT 1 FROM ({sites}) s WHERE s.contig = b.contig AND b.pos0 >= s.start0 AND b.pos0 < s.end0)),
covs AS (SELECT read_group, quality, CASE WHEN flag & 128 = 128 THEN -1 ELSE 1 END * (CASE WHEN flag & 16 = 16 THEN length(sequence) - spot ELSE spot + 1 END) AS cycle,
    CASE WHEN flag & 16 = 16 THEN translate(concat(CASE WHEN spot < length(sequence) - 1 THEN substr(sequence, spot + 2, 1) ELSE 'N' END, base), 'ACGT', 'TGCA')
         ELSE concat(CASE WHEN spot > 0 THEN substr(sequence, spot, 1) ELSE 'N' END, base) END AS context, base <> ref_base AS wrong FROM masked),
recal AS (SELECT read_group, quality, CAST(cycle AS INT) AS cycle, context, count(*) AS observations, count(*) FILTER (wrong) AS mismatches FROM covs
    GROUP BY GROUPING SETS ((read_group), (read_group, quality), (read_group, quality, cycle), (read_group, quality, context)))"""


def _applied(source: str) -> str:
    return f"""
emp AS (SELECT *, -10 * log10((mismatches + 1) / (observations + 2)) AS e FROM recal),
each AS (SELECT read_name, flag, read_group, sequence, length(sequence) AS size, unnest(range(length(sequence))) AS spot, qualities FROM {source}),
site AS (SELECT read_name, flag, read_group, spot, ascii(substr(qualities, spot + 1, 1)) - 33 AS quality,
    CASE WHEN flag & 128 = 128 THEN -1 ELSE 1 END * (CASE WHEN flag & 16 = 16 THEN size - spot ELSE spot + 1 END) AS cycle,
    CASE WHEN flag & 16 = 16 THEN translate(concat(CASE WHEN spot < size - 1 THEN substr(sequence, spot + 2, 1) ELSE 'N' END, substr(sequence, spot + 1, 1)), 'ACGT', 'TGCA')
         ELSE concat(CASE WHEN spot > 0 THEN substr(sequence, spot, 1) ELSE 'N' END, substr(sequence, spot + 1, 1)) END AS context FROM each),
fresh AS (SELECT s.read_name, s.flag, s.spot, greatest(1, least(60, CAST(floor(
        CASE WHEN q.e IS NULL THEN g.e ELSE q.e + coalesce(c.e - q.e, 0) + coalesce(x.e - q.e, 0) END + 0.5) AS INT))) AS v
    FROM site s JOIN emp g ON g.read_group = s.read_group AND g.quality IS NULL
    LEFT JOIN emp q ON q.read_group = s.read_group AND q.quality = s.quality AND q.cycle IS NULL AND q.context IS NULL
    LEFT JOIN emp c ON c.read_group = s.read_group AND c.quality = s.quality AND c.cycle = s.cycle
    LEFT JOIN emp x ON x.read_group = s.read_group AND x.quality = s.quality AND x.context = s.context)
SELECT read_name, flag, string_agg(chr(v + 33), '' ORDER BY spot) AS qualities FROM fresh GROUP BY read_name, flag"""


_SITES = "SELECT contig, start0, end0 FROM known_sites"
_add("recalibration_table", f"WITH {_recal('reads', _SITES)} SELECT * FROM recal", "reads", "ref_blocks", "known_sites")
_add("apply_recalibration", f"WITH {_recal('reads', _SITES)}, {_applied('reads')}", "reads", "ref_blocks", "known_sites")
_add("preprocess_reads_with_known_indels", f"""WITH {_frags('reads')}, {_KEEP}, {_MARK.format('reads')},
{_recal('marked', 'SELECT contig, start0, end0 FROM known_sites UNION SELECT contig, start0, end0 FROM known_indels')}, {_applied('marked')}""",
     "reads", "ref_blocks", "known_sites", "known_indels")

# ---- genotypes -----------------------------------------------------------------------------------------------


def _term(g: int) -> str:
    eps = "pow(10.0, -greatest(quality, 1) / 10.0)"
    ref, alt = f"({2 - g}.0 * {eps} + {g}.0 * (1 - {eps})) / 2.0", f"({2 - g}.0 * (1 - {eps}) + {g}.0 * {eps}) / 2.0"
    return f"CAST(sum(CAST(round(log10(CASE WHEN base = ref_base THEN {ref} ELSE {alt} END) * 1000000) AS BIGINT)) AS BIGINT) AS ll{g}"


_PILE = f"""{_ops("reads")}, {_BASES},
pile AS MATERIALIZED (SELECT sample, contig, pos0, ref_base, base AS allele, count(*) AS n, {_term(0)}, {_term(1)}, {_term(2)} FROM bases GROUP BY ALL)"""
_CALLS = f"""{_PILE},
alts AS MATERIALIZED (SELECT sample, contig, pos0, allele AS alt, row_number() OVER (PARTITION BY sample, contig, pos0 ORDER BY n DESC, allele) AS r FROM pile WHERE allele <> ref_base),
joined AS (SELECT p.sample, p.contig, p.pos0, p.ref_base AS ref, a.alt, coalesce(sum(p.n) FILTER (p.allele = p.ref_base), 0)::BIGINT AS n_ref,
    coalesce(sum(p.n) FILTER (p.allele = a.alt), 0)::BIGINT AS n_alt, CAST(sum(ll0) AS BIGINT) AS l0, CAST(sum(ll1) AS BIGINT) AS l1, CAST(sum(ll2) AS BIGINT) AS l2
    FROM pile p JOIN alts a ON a.r = 1 AND p.sample = a.sample AND p.contig = a.contig AND p.pos0 = a.pos0 AND (p.allele = p.ref_base OR p.allele = a.alt)
    GROUP BY p.sample, p.contig, p.pos0, p.ref_base, a.alt),
scaled AS (SELECT *, greatest(l0, l1, l2) AS top FROM joined),
phred AS (SELECT *, CASE WHEN l2 = top THEN 2 WHEN l1 = top THEN 1 ELSE 0 END AS ref_alleles,
    [CAST(round((top - l0) * 10 / 1000000.0) AS INT), CAST(round((top - l1) * 10 / 1000000.0) AS INT), CAST(round((top - l2) * 10 / 1000000.0) AS INT)] AS pls FROM scaled),
calls AS (SELECT sample, contig, pos0, ref, alt, n_ref, n_alt, ref_alleles, pls, least(99, list_sort(pls)[2]) AS gq FROM phred)"""
_add("pileup", f"""WITH {_PILE} SELECT sample, contig, pos0 // 500 AS stretch, ref_base, allele, count(*) AS cells, CAST(sum(n) AS BIGINT) AS n,
    CAST(sum(ll0) AS BIGINT) AS ll0, CAST(sum(ll1) AS BIGINT) AS ll1, CAST(sum(ll2) AS BIGINT) AS ll2 FROM pile GROUP BY ALL""", "reads", "ref_blocks")
_add("genotype_biallelic", f"""WITH {_CALLS} SELECT sample, substr(contig, 4) AS contig, pos0, ref, alt, n_ref, n_alt, ref_alleles,
    array_to_string(pls, ',') AS pl, gq FROM calls""", "reads", "ref_blocks")
# Joint: one alternate for all samples, every sample with a base of either allele, sites where any has the alternate.
_JOINT = f"""{_PILE},
others AS (SELECT contig, pos0, ref_base, allele, row_number() OVER (PARTITION BY contig, pos0 ORDER BY sum(n) DESC, allele) AS r FROM pile WHERE allele <> ref_base GROUP BY contig, pos0, ref_base, allele),
joined AS (SELECT p.sample, p.contig, p.pos0, p.ref_base AS ref, o.allele AS alt, coalesce(sum(p.n) FILTER (p.allele = p.ref_base), 0) AS n_ref, coalesce(sum(p.n) FILTER (p.allele = o.allele), 0) AS n_alt,
    CAST(sum(ll0) AS BIGINT) AS l0, CAST(sum(ll1) AS BIGINT) AS l1, CAST(sum(ll2) AS BIGINT) AS l2
    FROM pile p JOIN others o ON o.r = 1 AND p.contig = o.contig AND p.pos0 = o.pos0 AND (p.allele = p.ref_base OR p.allele = o.allele) GROUP BY p.sample, p.contig, p.pos0, p.ref_base, o.allele),
scaled AS (SELECT *, greatest(l0, l1, l2) AS top FROM joined),
phred AS (SELECT *, CASE WHEN l2 = top THEN 2 WHEN l1 = top THEN 1 ELSE 0 END AS ref_alleles,
    [CAST(round((top - l0) * 10 / 1000000.0) AS INT), CAST(round((top - l1) * 10 / 1000000.0) AS INT), CAST(round((top - l2) * 10 / 1000000.0) AS INT)] AS pls FROM scaled),
varied AS (SELECT DISTINCT contig, pos0 FROM phred WHERE ref_alleles < 2),
calls AS (SELECT sample, contig, pos0, ref, alt, n_ref, n_alt, ref_alleles, pls, least(99, list_sort(pls)[2]) AS gq FROM phred JOIN varied USING (contig, pos0))"""
_add("genotype_joint", f"""WITH {_JOINT} SELECT sample, contig, pos0, ref, alt, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_alt AS BIGINT) AS n_alt, ref_alleles,
    array_to_string(pls, ',') AS pl, gq FROM calls""", "reads", "ref_blocks")
_add("call_variants", f"WITH {_JOINT} SELECT sample, contig, pos0, ref, alt, ref_alleles, gq FROM calls", "reads", "ref_blocks")
_SAMPLES = [f"S{i}" for i in range(8)]
_CELLS = ", ".join(f"coalesce(max(cell) FILTER (sample = '{s}'), './.')" for s in _SAMPLES)
_add("write_vcf", f"""WITH {_JOINT},
cells AS (SELECT *, concat_ws(':', CASE ref_alleles WHEN 2 THEN '0/0' WHEN 1 THEN '0/1' ELSE '1/1' END, CAST(gq AS VARCHAR), array_to_string(pls, ',')) AS cell FROM calls)
SELECT concat_ws(chr(9), contig, CAST(pos0 + 1 AS VARCHAR), '.', ref, alt, '.', 'PASS', '.', 'GT:GQ:PL', {_CELLS}) AS line FROM cells GROUP BY contig, pos0, ref, alt
UNION ALL SELECT concat_ws(chr(9), '#CHROM', 'POS', 'ID', 'REF', 'ALT', 'QUAL', 'FILTER', 'INFO', 'FORMAT', {", ".join(f"'{s}'" for s in _SAMPLES)})""",
     "reads", "ref_blocks")

# ---- copy number ---------------------------------------------------------------------------------------------

_CENTRED = f"""{_DEPTH},
sized AS (SELECT *, avg(mean_depth) OVER (PARTITION BY target) AS m FROM cover WHERE end0 - start0 BETWEEN 10 AND 10000),
ts AS (SELECT * FROM sized WHERE m BETWEEN 0.05 AND 500),
ok AS (SELECT sample FROM ts GROUP BY sample HAVING avg(mean_depth) BETWEEN 0.01 AND 200 AND coalesce(stddev_samp(mean_depth), 0) <= 150),
centred AS (SELECT sample, target, mean_depth - avg(mean_depth) OVER (PARTITION BY target) AS value FROM ts WHERE sample IN (SELECT sample FROM ok))"""
_add("cnv_filter_matrix", f"WITH {_CENTRED} SELECT sample, target, round(value, 9) AS value FROM centred", "reads", "targets")
_add("cnv_zscore", f"""WITH {_CENTRED}, spread AS (SELECT *, coalesce(stddev_samp(value) OVER (PARTITION BY target), 0) AS sd FROM centred),
steady AS (SELECT * FROM spread WHERE sd <= 1.0)
SELECT sample, target, round((value - avg(value) OVER (PARTITION BY sample)) / stddev_samp(value) OVER (PARTITION BY sample), 6) AS z FROM steady""", "reads", "targets")

# ---- alignment -----------------------------------------------------------------------------------------------


def _index(k: int, most: int) -> str:
    return f"""windows AS (SELECT a.contig, a.block, length(a.seq) AS size, concat(a.seq, coalesce(b.seq, '')) AS w
            FROM ref_blocks a LEFT JOIN ref_blocks b ON b.contig = a.contig AND b.block = a.block + 1),
spots AS (SELECT contig, pos0, kmer FROM (SELECT contig, block * 96 + i AS pos0, substr(w, i + 1, {k}) AS kmer FROM (SELECT *, unnest(range(size)) AS i FROM windows))
          WHERE length(kmer) = {k}),
few AS (SELECT kmer FROM spots GROUP BY kmer HAVING count(*) <= {most}),
idx AS (SELECT kmer, contig, pos0 FROM spots WHERE kmer IN (SELECT kmer FROM few))"""


def _hits(source: str) -> str:
    return f"""{_index(12, 16)},
sided AS (SELECT name, 1 AS mate, seq1 AS s FROM {source} UNION ALL SELECT name, 2, seq2 FROM {source}),
turned AS (SELECT name, mate, '+' AS strand, s FROM sided UNION ALL SELECT name, mate, '-', reverse(translate(s, 'ACGT', 'TGCA')) FROM sided),
seeds AS (SELECT *, substr(s, off + 1, 12) AS kmer FROM (SELECT *, unnest(range(0, length(s) - 11, 6)) AS off FROM turned)),
votes AS (SELECT name, mate, strand, idx.contig, pos0 - off AS start0, any_value(s) AS s, count(*) AS votes FROM seeds JOIN idx USING (kmer)
          WHERE pos0 >= off GROUP BY ALL),
faced AS (SELECT v.name, v.mate, v.strand, v.contig, v.start0, v.votes, v.s, concat(b.seq, coalesce(c.seq, '')) AS w, v.start0 % 96 AS o
          FROM votes v JOIN ref_blocks b ON b.contig = v.contig AND b.block = v.start0 // 96
          LEFT JOIN ref_blocks c ON c.contig = v.contig AND c.block = v.start0 // 96 + 1),
scored AS (SELECT name, mate, strand, contig, start0, votes, length(s) AS size, hamming(s, rpad(substr(w, o + 1, length(s)), CAST(length(s) AS INT), '-')) AS mismatches FROM faced),
ranked AS (SELECT *, row_number() OVER w AS r, lead(mismatches) OVER w AS next FROM scored WHERE mismatches <= size * 0.2
           WINDOW w AS (PARTITION BY name, mate ORDER BY mismatches, votes DESC, contig, start0, strand)),
hits AS (SELECT name, mate, contig, start0, strand, votes, mismatches, CAST(CASE WHEN next IS NULL THEN 60 ELSE least(60, 10 * (next - mismatches)) END AS INT) AS mapq
         FROM ranked WHERE r = 1)"""


_add("kmer_index", f"WITH {_index(8, 12)} SELECT * FROM idx", "ref_blocks")
_add("align_seed_vote", f"WITH {_hits('fragments')} SELECT * FROM hits", "fragments", "ref_blocks")
_add("align_reads", f"""WITH {_TRIM}, {_hits('trimmed')},
sides AS (SELECT *, length(s) AS size FROM (SELECT name, 1 AS mate, seq1 AS s, qual1 AS q FROM trimmed UNION ALL SELECT name, 2, seq2, qual2 FROM trimmed)),
joined AS (SELECT d.*, h.contig, h.start0, h.strand, h.mapq FROM sides d LEFT JOIN hits h ON h.name = d.name AND h.mate = d.mate),
faces AS (SELECT *, lead(contig, 1) OVER w AS c2, lag(contig, 1) OVER w AS c1, lead(start0, 1) OVER w AS s2, lag(start0, 1) OVER w AS s1, lead(strand, 1) OVER w AS d2, lag(strand, 1) OVER w AS d1,
    lead(size, 1) OVER w AS z2, lag(size, 1) OVER w AS z1 FROM joined WINDOW w AS (PARTITION BY name ORDER BY mate)),
opposite AS (SELECT *, CASE WHEN mate = 1 THEN c2 ELSE c1 END AS oc, CASE WHEN mate = 1 THEN s2 ELSE s1 END AS os, CASE WHEN mate = 1 THEN d2 ELSE d1 END AS od, CASE WHEN mate = 1 THEN z2 ELSE z1 END AS oz FROM faces),
flags AS (SELECT *, contig = oc AND strand <> od AND greatest(start0 + size, os + oz) - least(start0, os) <= 1000 AS proper FROM opposite)
SELECT name AS read_name, CAST(1 + CASE WHEN mate = 1 THEN 64 ELSE 128 END + CASE WHEN proper THEN 2 ELSE 0 END + CASE WHEN contig IS NULL THEN 4 ELSE 0 END
    + CASE WHEN oc IS NULL THEN 8 ELSE 0 END + CASE WHEN strand = '-' THEN 16 ELSE 0 END + CASE WHEN od = '-' THEN 32 ELSE 0 END AS INT) AS flag,
    contig, start0, CASE WHEN contig IS NULL THEN '*' ELSE concat(CAST(size AS VARCHAR), 'M') END AS cigar, coalesce(mapq, 0) AS mapq,
    CASE WHEN strand = '-' THEN reverse(translate(s, 'ACGT', 'TGCA')) ELSE s END AS sequence, CASE WHEN strand = '-' THEN reverse(q) ELSE q END AS qualities,
    'rg1' AS read_group, 'A' AS sample FROM flags""", "fragments", "ref_blocks")

# ---- scalar functions ----------------------------------------------------------------------------------------

_add("cigar_functions", f"""WITH {_ops("reads")}
SELECT read_name, flag, CAST(count(*) AS INT) AS n_ops, CAST(sum(len) FILTER (op IN ('M', 'D', 'N')) AS INT) AS ref_length,
    CAST(sum(len) FILTER (op IN ('M', 'I', 'S')) AS INT) AS query_length,
    CAST(CASE WHEN flag & 16 = 16 THEN max(end0) - 1 + coalesce(max(len) FILTER (op = 'S' AND i > 1), 0) ELSE min(start0) - coalesce(max(len) FILTER (op = 'S' AND i = 1), 0) END AS BIGINT) AS unclipped_5p
FROM ops GROUP BY read_name, flag""", "reads")
_add("phred_functions", """SELECT read_name, flag, qualities AS encoded,
    CAST(list_sum(list_transform(string_split(qualities, ''), lambda c: CASE WHEN ascii(c) >= 48 THEN ascii(c) - 33 ELSE 0 END)) AS BIGINT) AS score,
    round(pow(10.0, -(ascii(qualities) - 33) / 10.0), 8) AS first_error FROM reads""", "reads")
_add("reverse_complement", "SELECT read_name, flag, reverse(translate(sequence, 'ACGT', 'TGCA')) AS rc FROM reads", "reads")
_add("sam_flag_is", """SELECT read_name, flag, flag & 2 = 2 AS proper_pair, flag & 16 = 16 AS reverse, flag & 64 = 64 AS first_in_pair FROM reads""", "reads")
_add("contig_style", "SELECT read_name, flag, substr(contig, 4) AS grc, contig AS ucsc FROM reads", "reads")


# ---- chains from files to files, comparisons -----------------------------------------------------------------

ORACLE["sam_folder_round_trip"] = ORACLE["scan_sam"]
ORACLE["align_files"] = ORACLE["align_reads"]
ORACLE["call_variants_files"] = ORACLE["write_vcf"]
ORACLE["preprocess_files_with_known_indels"] = ORACLE["preprocess_reads_with_known_indels"]


def _tally(**variants: tuple[str, str]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{name}' AS variant, count(*) AS n_rows, CAST(coalesce(sum({value}), 0) AS BIGINT) AS total FROM ({ORACLE[query]}) {name}_rows"
                               for name, (query, value) in variants.items())


ORACLE["bench_sort"] = _tally(coordinate=("sort_coordinate", "rank * (flag + 1)"), queryname=("sort_queryname", "rank * (flag + 1)"))
ORACLE["bench_duplicates"] = _tally(mark=("mark_duplicates", "flag"), remove=("remove_duplicates", "flag"), by_name=("mark_duplicates_by_name", "flag"))
ORACLE["bench_recalibration"] = _tally(table=("recalibration_table", "observations"), apply=("apply_recalibration", "ascii(substr(qualities, 5, 1))"))
ORACLE["bench_realignment"] = _tally(targets=("realignment_targets", "end0 - start0"), gains=("realign_gains", "gain"), realign=("realign_indels", "end0"))
