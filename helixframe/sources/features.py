"""Target regions and annotations in the common text formats."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.schemas import FEATURES
from helixframe.sources.stringency import stringency

_NO_MAP = "cast(map() as map<string,string>)"


def _rows(spark: SparkSession, paths, mode: str, least: int, numeric: tuple[int, int], label: str,
          comments: tuple[str, ...] = ("#",)) -> DataFrame:
    lines = spark.read.text(paths).where(F.trim("value") != "")
    for mark in comments:
        lines = lines.where(~F.col("value").startswith(mark))
    parts = F.split("value", "\t")
    good = F.size(parts) >= least
    for i in numeric:
        good = good & F.get(parts, F.lit(i)).rlike("^[0-9]+$")
    return stringency(lines, mode, ~good, "value", label).withColumn("p", parts)


def _given(i: int):
    value = F.get("p", F.lit(i))
    return F.when(value != ".", value)


def _shape(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FEATURES.fields])


def scan_bed(spark: SparkSession, paths, mode: str = "STRICT") -> DataFrame:
    """BED, 3 to 12 columns, already 0-based and half-open."""
    rows = _rows(spark, paths, mode, 3, (1, 2), "BED line", ("#", "track", "browser"))
    p = F.col("p")
    extra = F.map_filter(F.map_from_arrays(
        F.array(*[F.lit(n) for n in ("thickStart", "thickEnd", "itemRgb", "blockCount", "blockSizes", "blockStarts")]),
        F.array(*[F.get("p", F.lit(i)) for i in range(6, 12)])), lambda k, v: v.isNotNull())
    return _shape(rows.select(
        p[0].alias("contig"), p[1].cast("bigint").alias("start0"), p[2].cast("bigint").alias("end0"),
        _given(3).alias("name"), _given(4).try_cast("double").alias("score"), _given(5).alias("strand"),
        F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("type"), extra.alias("attributes")))


def scan_narrowpeak(spark: SparkSession, paths, mode: str = "STRICT") -> DataFrame:
    """BED6 plus signal, p, q and peak, which go to the attributes."""
    rows = _rows(spark, paths, mode, 10, (1, 2), "narrowPeak line", ("#", "track", "browser"))
    p = F.col("p")
    extra = F.map_from_arrays(F.array(*[F.lit(n) for n in ("signalValue", "pValue", "qValue", "peak")]), F.slice("p", 7, 4))
    return _shape(rows.select(
        p[0].alias("contig"), p[1].cast("bigint").alias("start0"), p[2].cast("bigint").alias("end0"),
        _given(3).alias("name"), _given(4).try_cast("double").alias("score"), _given(5).alias("strand"),
        F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("type"), extra.alias("attributes")))


def _nine_columns(rows: DataFrame, attributes, name) -> DataFrame:
    p = F.col("p")
    return _shape(rows.withColumn("attributes", attributes).select(
        p[0].alias("contig"), (p[3].cast("bigint") - 1).alias("start0"), p[4].cast("bigint").alias("end0"),
        name.alias("name"), _given(5).try_cast("double").alias("score"), _given(6).alias("strand"),
        _given(1).alias("source"), _given(2).alias("type"), "attributes"))


def scan_gtf(spark: SparkSession, paths, mode: str = "STRICT") -> DataFrame:
    """GTF/GFF2: 1-based closed; attributes written ``key "value";``."""
    rows = _rows(spark, paths, mode, 9, (3, 4), "GTF line")
    found = F.regexp_extract_all(F.col("p")[8], F.lit(r'([A-Za-z0-9_.]+)\s+("[^"]*"|[^\s;]+)'), F.lit(0))
    pairs = F.transform(found, lambda t: F.struct(
        F.regexp_extract(t, r"^(\S+)", 1).alias("k"), F.regexp_extract(t, r'^\S+\s+"?([^"]*)"?$', 1).alias("v")))
    # A repeated key keeps its last value.
    unique = F.filter(pairs, lambda e, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda o: o["k"] == e["k"]))
    a = F.col("attributes")
    name = F.coalesce(a["name"], a["exon_id"], a["transcript_id"], a["gene_id"])
    return _nine_columns(rows, F.map_from_entries(unique), name)


def scan_gff3(spark: SparkSession, paths, mode: str = "STRICT") -> DataFrame:
    """GFF3: 1-based closed; attributes ``k=v;`` with percent escapes."""
    rows = _rows(spark, paths, mode, 9, (3, 4), "GFF3 line")
    pairs = F.transform(F.filter(F.split(F.col("p")[8], ";"), lambda t: F.instr(t, "=") > 1), lambda t: F.struct(
        _unescape(F.trim(F.substring_index(t, "=", 1))).alias("k"),
        _unescape(t.substr(F.instr(t, "=") + 1, F.length(t))).alias("v")))
    a = F.col("attributes")
    return _nine_columns(rows, F.map_from_entries(pairs), F.coalesce(a["Name"], a["ID"]))


def _unescape(text):
    # A plus sign is a plus sign in GFF3; url_decode would make it a blank.
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def scan_interval_list(spark: SparkSession, paths, mode: str = "STRICT") -> DataFrame:
    """Interval list: ``@`` header, then contig, 1-based closed start and end, strand, name."""
    rows = _rows(spark, paths, mode, 3, (1, 2), "interval line", ("@",))
    p = F.col("p")
    return _shape(rows.select(
        p[0].alias("contig"), (p[1].cast("bigint") - 1).alias("start0"), p[2].cast("bigint").alias("end0"),
        _given(4).alias("name"), F.lit(None).cast("double").alias("score"), _given(3).alias("strand"),
        F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("type"),
        F.expr(_NO_MAP).alias("attributes")))


def scan_features_parquet(spark: SparkSession, paths) -> DataFrame:
    """Columnar features; columns a file lacks come back null."""
    df = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    missing = [f for f in FEATURES.fields if f.name not in df.columns]
    for f in missing:
        df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return _shape(df)


#: Reader by file ending.
READERS = {".bed": scan_bed, ".gtf": scan_gtf, ".gff": scan_gtf, ".gff2": scan_gtf, ".gff3": scan_gff3,
           ".interval_list": scan_interval_list, ".narrowpeak": scan_narrowpeak}


def scan_features(spark: SparkSession, path: str, mode: str = "STRICT") -> DataFrame:
    lower = path.lower()
    for ending, reader in READERS.items():
        if lower.endswith(ending):
            return reader(spark, path, mode)
    return scan_features_parquet(spark, path)
