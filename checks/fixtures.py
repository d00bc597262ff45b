"""Sequencing tables derived from the driver tables; one SQL text per table for both engines.

Every row of the source table is used. The genome grows with ``part`` (96 bases per part on each of three
contigs) and the reads with ``lineitem``, so depth stays the same at every scale factor.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.runtime import stage

CONTIGS = ["chr1", "chr2", "chr3"]
#: Bases per reference block row.
BLOCK = 96
#: Three-prime adapters planted in the raw fragments.
ADAPTER_FWD = "AGATCGGAAGAGCACACG"
ADAPTER_REV = "AGATCGGAAGAGCGTCGT"


def _md5_block(k: int) -> str:
    return (f"translate(md5(concat(contig, ':', CAST(CAST(floor(start0 / 32) AS BIGINT) + {k} AS STRING))), "
            "'0123456789abcdef', 'ACGTACGTACGTACGT')")


_WINDOW = (f"substr(concat({_md5_block(0)}, {_md5_block(1)}, {_md5_block(2)}, {_md5_block(3)}), "
           "CAST(start0 % 32 AS INT) + 1, 86)")

SQL: dict[str, str] = {}

SQL["molecules"] = """
SELECT concat(CAST(l_orderkey AS STRING), ':', CAST(l_partkey AS STRING), ':', CAST(l_suppkey AS STRING), ':',
              CAST(l_linenumber AS STRING)) AS read_name,
       concat('chr', CAST(l_suppkey % 3 + 1 AS STRING)) AS contig,
       l_partkey * 92 + (l_orderkey % 7) * 13 AS s0, 80 + (l_suppkey % 5) * 13 AS isize,
       l_orderkey * 31 + l_partkey * 7 + l_linenumber AS h, CAST(floor(l_quantity) AS INT) AS q,
       l_linenumber % 2 AS odd, CAST(l_suppkey % 8 AS INT) AS grp
FROM {lineitem}"""

SQL["mates"] = f"""
SELECT read_name, contig, 64 AS mate_bit, h AS hf, h AS hm, q, grp,
       CASE WHEN odd = 0 THEN s0 ELSE s0 + isize - 36 END AS start0,
       CASE WHEN odd = 0 THEN s0 + isize - 36 ELSE s0 END AS other0,
       CASE WHEN odd = 0 THEN 0 ELSE 1 END AS rev,
       CASE WHEN h % 37 = 0 THEN 1 ELSE 0 END AS unm, CASE WHEN (h + 1) % 37 = 0 THEN 1 ELSE 0 END AS mate_unm,
       CASE WHEN h % 211 = 0 THEN 20000 + isize ELSE isize END AS isz
FROM ({SQL["molecules"]}) m1
UNION ALL
SELECT read_name, contig, 128 AS mate_bit, h AS hf, h + 1 AS hm, q, grp,
       CASE WHEN odd = 0 THEN s0 + isize - 36 ELSE s0 END AS start0,
       CASE WHEN odd = 0 THEN s0 ELSE s0 + isize - 36 END AS other0,
       CASE WHEN odd = 0 THEN 1 ELSE 0 END AS rev,
       CASE WHEN (h + 1) % 37 = 0 THEN 1 ELSE 0 END AS unm, CASE WHEN h % 37 = 0 THEN 1 ELSE 0 END AS mate_unm,
       CASE WHEN h % 211 = 0 THEN 20000 + isize ELSE isize END AS isz
FROM ({SQL["molecules"]}) m2"""

SQL["reads"] = f"""
SELECT read_name,
       CAST(1 + (CASE WHEN unm = 1 OR mate_unm = 1 OR hf % 5 = 0 THEN 0 ELSE 2 END) + 4 * unm + 8 * mate_unm
            + 16 * rev + 32 * (1 - rev) + mate_bit AS INT) AS flag,
       CASE WHEN unm = 1 THEN NULL ELSE contig END AS contig,
       CASE WHEN unm = 1 THEN NULL ELSE start0 END AS start0,
       CASE WHEN unm = 1 THEN NULL ELSE start0 + (CASE cigar WHEN '20M2D16M' THEN 38 WHEN '18M3I15M' THEN 33
            WHEN '30M6S' THEN 30 WHEN '6S30M' THEN 30 WHEN '16M50N20M' THEN 86 ELSE 36 END) END AS end0,
       CASE WHEN unm = 1 THEN 0 ELSE q END AS mapq,
       CASE WHEN unm = 1 THEN '*' ELSE cigar END AS cigar,
       CASE WHEN mate_unm = 1 THEN NULL ELSE contig END AS mate_contig,
       CASE WHEN mate_unm = 1 THEN NULL ELSE other0 END AS mate_start0,
       CASE WHEN unm = 1 OR mate_unm = 1 THEN 0 WHEN rev = 1 THEN -isz ELSE isz END AS tlen,
       CASE WHEN hm % 3 = 0 THEN concat(substr(seq, 1, off), translate(substr(seq, off + 1, 1), 'ACGT', 'CGTA'),
            substr(seq, off + 2)) ELSE seq END AS sequence,
       substr(repeat('I?5+I?I5', 8), CAST(hm % 8 AS INT) + 1, 36) AS qualities,
       concat('rg', CAST(grp AS STRING)) AS read_group, concat('lib', CAST(grp % 2 AS STRING)) AS library,
       concat('S', CAST(grp AS STRING)) AS sample
FROM (
  SELECT *, CASE cigar WHEN '20M2D16M' THEN concat(substr(w, 1, 20), substr(w, 23, 16))
                       WHEN '18M3I15M' THEN concat(substr(w, 1, 18), 'ACG', substr(w, 19, 15))
                       WHEN '30M6S' THEN concat(substr(w, 1, 30), 'TTTTTT')
                       WHEN '6S30M' THEN concat('GGGGGG', substr(w, 1, 30))
                       WHEN '16M50N20M' THEN concat(substr(w, 1, 16), substr(w, 67, 20))
                       ELSE substr(w, 1, 36) END AS seq
  FROM (SELECT *, CAST(hm % 36 AS INT) AS off,
               CASE hm % 23 WHEN 0 THEN '20M2D16M' WHEN 1 THEN '18M3I15M' WHEN 2 THEN '30M6S' WHEN 3 THEN '6S30M'
                            WHEN 4 THEN '16M50N20M' ELSE '36M' END AS cigar,
               {_WINDOW} AS w
        FROM ({SQL["mates"]}) a) b) c"""

# Two-read fragments of 48 bases; inserts shorter than that run into the adapter.
_RC = "reverse(translate({0}, 'ACGT', 'TGCA'))"
_FILL = "CACTGTGACATTACGGCATTAGGCTTAACGGATACA"
SQL["fragments"] = f"""
SELECT name, substr(concat(ins, '{ADAPTER_FWD}', '{_FILL}'), 1, 48) AS seq1,
       substr(repeat('I?5+I?I5', 8), CAST(h % 8 AS INT) + 1, 48) AS qual1,
       substr(concat({_RC.format("ins")}, '{ADAPTER_REV}', '{_FILL}'), 1, 48) AS seq2,
       substr(repeat('I5I?5+I?', 8), CAST(h % 7 AS INT) + 1, 48) AS qual2,
       contig AS true_contig, start0 AS true_start0
FROM (SELECT read_name AS name, h, contig, start0, substr({_WINDOW}, 1, CAST(24 + h % 50 AS INT)) AS ins
      FROM (SELECT *, s0 AS start0 FROM ({SQL["molecules"]}) m) a) b"""

SQL["targets"] = """
SELECT concat('chr', CAST(p_partkey % 3 + 1 AS STRING)) AS contig, p_partkey * 92 + 20 AS start0,
       p_partkey * 92 + 70 + p_size AS end0, concat('t', CAST(p_partkey AS STRING)) AS name,
       CAST(p_size AS DOUBLE) AS score, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
       p_brand AS source, 'exon' AS type
FROM {part}"""

# One substitution per customer and one indel per supplier.
SQL["known_sites"] = f"""
SELECT contig, start0, start0 + 1 AS end0, substr({_WINDOW}, 1, 1) AS ref,
       translate(substr({_WINDOW}, 1, 1), 'ACGT', 'GTAC') AS alt, concat('rs', CAST(c_custkey AS STRING)) AS id
FROM (SELECT c_custkey, concat('chr', CAST(c_custkey % 3 + 1 AS STRING)) AS contig,
             c_custkey * 122 + c_nationkey AS start0 FROM {{customer}}) s"""

SQL["known_indels"] = f"""
SELECT contig, start0, start0 + len_ref AS end0, substr({_WINDOW}, 1, len_ref) AS ref,
       CASE WHEN len_ref = 1 THEN concat(substr({_WINDOW}, 1, 1), 'ACG') ELSE substr({_WINDOW}, 1, 1) END AS alt,
       concat('indel', CAST(s_suppkey AS STRING)) AS id
FROM (SELECT s_suppkey, concat('chr', CAST(s_suppkey % 3 + 1 AS STRING)) AS contig,
             s_suppkey * 1800 + 500 AS start0, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 3 END AS len_ref
      FROM {{supplier}}) s"""

SQL["exons"] = """
SELECT concat('tx', CAST(p_partkey AS STRING)) AS transcript,
       concat('chr', CAST(p_partkey % 3 + 1 AS STRING)) AS contig, p_partkey * 92 AS start0,
       p_partkey * 92 + 16 AS end0, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand
FROM {part}
UNION ALL
SELECT concat('tx', CAST(p_partkey AS STRING)) AS transcript,
       concat('chr', CAST(p_partkey % 3 + 1 AS STRING)) AS contig, p_partkey * 92 + 66 AS start0,
       p_partkey * 92 + 130 AS end0, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand
FROM {part}"""

SQL["junctions"] = """
SELECT concat('chr', CAST(p_partkey % 3 + 1 AS STRING)) AS contig, p_partkey * 92 + 16 AS start0,
       p_partkey * 92 + 66 AS end0, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand
FROM {part}"""

# Extra loci: repeats of a read at further places (secondary, up to 24 of them) and split hits.
_LOCUS = """
SELECT read_name, flag + 256 AS flag, contig, start0 + 92 * n AS start0, end0 + 92 * n AS end0, 0 AS mapq, cigar,
       mate_contig, mate_start0, tlen, sequence, qualities, read_group, library, sample
FROM (SELECT *, {numbers} AS n FROM ({reads}) r0
      WHERE contig IS NOT NULL AND h29 = 0) r1
WHERE n <= CASE WHEN h3 = 0 THEN 24 ELSE 1 END"""
_SPLIT = """
SELECT read_name, flag + 2048 AS flag, contig, start0 + 400 AS start0, start0 + 400 + keep AS end0, mapq,
       concat(CAST(36 - keep AS STRING), 'S', CAST(keep AS STRING), 'M') AS cigar, mate_contig, mate_start0, tlen,
       sequence, qualities, read_group, library, sample
FROM (SELECT *, 16 + ascii(substr(sequence, 1, 1)) % 4 AS keep FROM ({reads}) r2
      WHERE contig IS NOT NULL AND cigar = '30M6S') r3"""
_HASHED = """
SELECT *, (ascii(substr(sequence, 2, 1)) + ascii(substr(sequence, 3, 1)) * 3 + ascii(substr(sequence, 4, 1)) * 5
        + ascii(substr(sequence, 6, 1)) * 7) % 29 AS h29,
       (ascii(substr(sequence, 7, 1)) + ascii(substr(sequence, 8, 1)) * 2) % 3 AS h3
FROM ({reads}) r"""
_COLUMNS = ("read_name, flag, contig, start0, end0, mapq, cigar, mate_contig, mate_start0, tlen, sequence, "
            "qualities, read_group, library, sample")


def alignments_sql(numbers: str, reads: str) -> str:
    hashed = _HASHED.replace("{reads}", reads)
    return (f"SELECT {_COLUMNS} FROM ({reads}) a0 UNION ALL "
            + _LOCUS.replace("{numbers}", numbers).replace("{reads}", hashed)
            + " UNION ALL " + _SPLIT.replace("{reads}", reads))


def ref_blocks_sql(contigs: str) -> str:
    def piece(k):
        return (f"translate(md5(concat(contig, ':', CAST(block * 3 + {k} AS STRING))), '0123456789abcdef', "
                "'ACGTACGTACGTACGT')")
    return (f"SELECT contig, block, concat({piece(0)}, {piece(1)}, {piece(2)}) AS seq "
            f"FROM (SELECT {contigs} AS contig, p_partkey AS block FROM {{part}}) g")


_HEX, _ACGT = "'0123456789abcdef'", "'ACGTACGTACGTACGT'"


def _late(text: str, blocks: tuple[str, str] = ("TRUE", "TRUE")) -> str:
    """``text`` over the window still in hex digits; ``blocks`` tell where its third and fourth block are needed.

    The lambda keeps the digests out of the one method that Spark makes of a whole stage, which the JVM does not compile once it is long.
    """
    digests = [_md5_block(k).removeprefix("translate(").removesuffix(f", {_HEX}, {_ACGT})") for k in range(4)]
    parts = [*digests[:2], *[f"CASE WHEN {need} THEN {d} ELSE '' END" for need, d in zip(blocks, digests[2:])]]
    window = f"substr(concat({', '.join(parts)}), element_at(transform(array(CAST(start0 % 32 AS INT)), x -> x + 1), 1), 86)"
    if _WINDOW not in text:
        raise ValueError("the text has no window")
    return text.replace(_WINDOW, window)


def _between(text: str, first: str, last: str) -> str:
    start = text.index(first)
    return text[start:text.index(last, start)]


# Both mates in one pass over the molecules; what a filter on bases is pushed to names the places, not how they are made.
_SPARK_MATES = f"""
SELECT read_name, contig, h AS hf, q, grp, CASE WHEN h % 211 = 0 THEN 20000 + isize ELSE isize END AS isz, inline(array(
       struct(64 AS mate_bit, h AS hm, CASE WHEN odd = 0 THEN s0 ELSE s0 + isize - 36 END AS start0,
              CASE WHEN odd = 0 THEN s0 + isize - 36 ELSE s0 END AS other0, CASE WHEN odd = 0 THEN 0 ELSE 1 END AS rev,
              CASE WHEN h % 37 = 0 THEN 1 ELSE 0 END AS unm, CASE WHEN (h + 1) % 37 = 0 THEN 1 ELSE 0 END AS mate_unm),
       struct(128 AS mate_bit, h + 1 AS hm, CASE WHEN odd = 0 THEN s0 + isize - 36 ELSE s0 END AS start0,
              CASE WHEN odd = 0 THEN s0 ELSE s0 + isize - 36 END AS other0, CASE WHEN odd = 0 THEN 1 ELSE 0 END AS rev,
              CASE WHEN (h + 1) % 37 = 0 THEN 1 ELSE 0 END AS unm, CASE WHEN h % 37 = 0 THEN 1 ELSE 0 END AS mate_unm)))
FROM ({SQL["molecules"]}) m"""


def _spark_reads() -> str:
    """``reads`` with the bases translated last and once, and each text named once, so that filters pushed below do not repeat it."""
    text = _late(SQL["reads"].replace(SQL["mates"], _SPARK_MATES), ("start0 % 32 NOT BETWEEN 0 AND 26 OR hm % 23 = 4", "start0 % 32 < 0 OR hm % 23 = 4"))
    bases = _between(text, "CASE cigar WHEN '20M2D16M' THEN concat", " AS seq\n")
    # by what the CIGAR is made of: else a filter on end0 carries the choice of the CIGAR once for each length, more code than the JVM compiles
    span = _between(text, "CASE cigar WHEN '20M2D16M' THEN 38", ") END AS end0")
    text = text.replace(span, "CASE CAST(hm % 23 AS INT) WHEN 0 THEN 38 WHEN 1 THEN 33 WHEN 2 THEN 30 WHEN 3 THEN 30 WHEN 4 THEN 86 ELSE 36 END")
    text = text.replace(bases, f"translate(element_at(transform(array(w), w -> {bases}), 1), {_HEX}, {_ACGT})")
    mutated = _between(text, "CASE WHEN hm % 3 = 0", " AS sequence,")
    return text.replace(mutated, f"element_at(transform(array(seq), seq -> {mutated}), 1)")


def _spark_fragments() -> str:
    """``fragments`` with the insert translated once, after it is cut to its length."""
    longest = "start0 % 32 + 24 + h % 50"
    text = _late(SQL["fragments"], (f"start0 % 32 < 0 OR {longest} > 64", f"start0 % 32 < 0 OR {longest} > 96"))
    cut = _between(text, "substr(substr(concat(md5", " AS ins\n")
    return text.replace(cut, f"translate({cut}, {_HEX}, {_ACGT})")


# All places of a read in one pass over the reads: itself (0), its repeats (1, 2, ...) and its split hit (-1).
SPARK_ALIGNMENTS = """
SELECT read_name, flag + CASE WHEN n > 0 THEN 256 WHEN n < 0 THEN 2048 ELSE 0 END AS flag, contig,
       CASE WHEN n < 0 THEN start0 + 400 ELSE start0 + 92 * n END AS start0,
       CASE WHEN n < 0 THEN start0 + 400 + keep ELSE end0 + 92 * n END AS end0,
       CASE WHEN n > 0 THEN 0 ELSE mapq END AS mapq,
       CASE WHEN n < 0 THEN concat(CAST(36 - keep AS STRING), 'S', CAST(keep AS STRING), 'M') ELSE cigar END AS cigar,
       mate_contig, mate_start0, tlen, sequence, qualities, read_group, library, sample
FROM (SELECT *, 16 + ascii(substr(sequence, 1, 1)) % 4 AS keep, explode(concat(array(0),
             CASE WHEN contig IS NULL OR h29 IS NULL OR h29 <> 0 THEN array() WHEN h3 = 0 THEN sequence(1, 24) ELSE array(1) END,
             CASE WHEN contig IS NOT NULL AND cigar = '30M6S' THEN array(-1) ELSE array() END)) AS n
      FROM (""" + _HASHED + """) h) p"""

SPARK_ONLY = {"ref_blocks": ref_blocks_sql("explode(array('chr1', 'chr2', 'chr3'))"), "reads": _spark_reads(), "fragments": _spark_fragments()}
DUCK_ONLY = {"ref_blocks": ref_blocks_sql("unnest(['chr1', 'chr2', 'chr3'])")}

_TABLES = ("lineitem", "part", "customer", "supplier")
_STAGED: dict[tuple, DataFrame] = {}
#: Columns of the source tables that the derived tables are made of.
_USED = {"lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"], "part": ["p_partkey", "p_size", "p_brand"],
         "customer": ["c_custkey", "c_nationkey"], "supplier": ["s_suppkey"]}
_FILE_ROWS = 500_000


def duck(name: str) -> str:
    """DuckDB text of a derived table over the registered views."""
    if name == "alignments":
        return alignments_sql("unnest(range(1, 25))", "SELECT * FROM reads")
    text = DUCK_ONLY.get(name) or SQL[name]
    for table in _TABLES:
        text = text.replace("{" + table + "}", table)
    return text


def with_tables(body: str, *names: str) -> str:
    """Prefix ``body`` with the derived tables it uses."""
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({duck(n)})" for n in names)
    joined = body.strip()
    if joined[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{joined[5:]}"
    return f"WITH {ctes}\n{joined}"


class Fixture:
    """Derived tables of one scale directory.

    The columns they are made of are dealt over files once per application, in the shared folder: a source table may be one file that
    few tasks can read. Tables with rows for each line item are derived whenever they are read, and only the columns asked for; the
    tables with rows for each part, customer or supplier, which joins read several times, are written once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _once(self, name: str, make) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _STAGED:
            _STAGED[key] = stage(make(), name)
        return _STAGED[key]

    def _source(self, name: str) -> DataFrame:
        """The columns of a source table that derived tables use, in files of about ``_FILE_ROWS`` rows."""
        def dealt():
            narrow = self.table(name).select(*_USED[name])
            files = max(self.spark.sparkContext.defaultParallelism, -(-narrow.count() // _FILE_ROWS))
            return narrow.repartition(files, *_USED[name])
        return self._once(f"source-{name}", dealt)

    def _derive(self, name: str) -> DataFrame:
        text = SPARK_ONLY.get(name) or SQL[name]
        used = {t: self._source(t) for t in _TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    def _staged(self, name: str) -> DataFrame:
        return self._once(name, lambda: self._derive(name))

    @cached_property
    def reads(self) -> DataFrame:
        return self._derive("reads")

    @cached_property
    def alignments(self) -> DataFrame:
        """Reads plus secondary and split hits."""
        return self.spark.sql(SPARK_ALIGNMENTS, reads=self.reads)

    @cached_property
    def fragments(self) -> DataFrame:
        return self._derive("fragments")

    @cached_property
    def ref_blocks(self) -> DataFrame:
        return self._staged("ref_blocks")

    @cached_property
    def targets(self) -> DataFrame:
        return self._staged("targets")

    @cached_property
    def known_sites(self) -> DataFrame:
        return self._staged("known_sites")

    @cached_property
    def known_indels(self) -> DataFrame:
        return self._staged("known_indels")

    @cached_property
    def exons(self) -> DataFrame:
        return self._staged("exons")

    @cached_property
    def junctions(self) -> DataFrame:
        return self._staged("junctions")

    @cached_property
    def contigs(self) -> DataFrame:
        """Dictionary of contigs, measured on the reference blocks."""
        return (self.ref_blocks.groupBy("contig").agg(F.sum(F.length("seq")).cast("bigint").alias("length"))
                .withColumn("ordinal", F.regexp_extract("contig", "([0-9]+)$", 1).cast("int") - 1))
