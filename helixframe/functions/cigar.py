"""CIGAR expressions. All are native Spark expressions; reads with one M run skip the general path."""
from pyspark.sql import Column
from pyspark.sql import functions as F

_OP = r"([0-9]+)([MIDNSHP=X])"
_ONE_RUN = r"^[0-9]+M$"
_BLOCKS = "array<struct<ref_start:bigint,read_start:int,len:int>>"
_INTRONS = "array<struct<start0:bigint,end0:bigint,left:int,right:int>>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cigar_ops(cigar: Column | str) -> Column:
    """ARRAY<STRUCT<len INT, op STRING>>; empty for ``*``."""
    tokens = F.regexp_extract_all(_col(cigar), F.lit(_OP), F.lit(0))
    return F.transform(tokens, lambda t: F.struct(
        t.substr(F.lit(1), F.length(t) - 1).cast("int").alias("len"), F.right(t, F.lit(1)).alias("op")))


def _sum_of(cigar: Column | str, ops: str) -> Column:
    c = _col(cigar)
    total = F.aggregate(cigar_ops(c), F.lit(0), lambda acc, o: acc + F.when(
        F.instr(F.lit(ops), o["op"]) > 0, o["len"]).otherwise(F.lit(0)))
    return F.when(c.rlike(_ONE_RUN), F.regexp_extract(c, "^([0-9]+)", 1).try_cast("int")).otherwise(total)


def ref_length(cigar: Column | str) -> Column:
    return _sum_of(cigar, "MDN=X")


def query_length(cigar: Column | str) -> Column:
    return _sum_of(cigar, "MIS=X")


def aligned_length(cigar: Column | str) -> Column:
    return _sum_of(cigar, "M=X")


def _clip(cigar: Column, pattern_h: str, pattern_s: str) -> Column:
    def number(p):
        found = F.regexp_extract(cigar, p, 1)  # a cast that fails costs an exception for each row
        return F.coalesce(F.when(found != "", found.try_cast("int")), F.lit(0))
    return F.when(cigar.contains("S") | cigar.contains("H"), number(pattern_h) + number(pattern_s)).otherwise(F.lit(0))


def leading_clip(cigar: Column | str) -> Column:
    return _clip(_col(cigar), r"^([0-9]+)H", r"^(?:[0-9]+H)?([0-9]+)S")


def trailing_clip(cigar: Column | str) -> Column:
    return _clip(_col(cigar), r"([0-9]+)H$", r"([0-9]+)S(?:[0-9]+H)?$")


def unclipped_5p(cigar: Column | str, start0: Column | str, end0: Column | str, reverse: Column) -> Column:
    """Position of the first sequenced base had nothing been clipped."""
    return F.when(reverse, _col(end0) - 1 + trailing_clip(cigar)).otherwise(_col(start0) - leading_clip(cigar))


def aligned_blocks(cigar: Column | str, start0: Column | str) -> Column:
    """ARRAY<STRUCT<ref_start, read_start, len>>: one entry per M, = or X run."""
    c, s = _col(cigar), _col(start0).cast("bigint")

    def step(acc, o):
        size, op = o["len"], o["op"]
        match = op.isin("M", "=", "X")
        block = F.array(F.struct(acc["r"].alias("ref_start"), acc["q"].alias("read_start"), size.alias("len")))
        return F.struct(
            (acc["r"] + F.when(match | op.isin("D", "N"), size).otherwise(0)).cast("bigint").alias("r"),
            (acc["q"] + F.when(match | op.isin("I", "S"), size).otherwise(0)).cast("int").alias("q"),
            F.when(match, F.concat(acc["b"], block)).otherwise(acc["b"]).alias("b"))

    zero = F.struct(s.alias("r"), F.lit(0).alias("q"), F.array().cast(_BLOCKS).alias("b"))
    general = F.aggregate(cigar_ops(c), zero, step, lambda acc: acc["b"])
    single = F.array(F.struct(s.alias("ref_start"), F.lit(0).alias("read_start"),
                              F.regexp_extract(c, "^([0-9]+)", 1).try_cast("int").alias("len")))
    return F.when(c.rlike(_ONE_RUN), single).otherwise(general)


def introns(cigar: Column | str, start0: Column | str) -> Column:
    """ARRAY<STRUCT<start0, end0, left, right>> per N gap; left/right = aligned bases beside it.

    ``left`` counts aligned bases back to the previous gap, ``right`` those up to the next one.
    """
    c, s = _col(cigar), _col(start0).cast("bigint")

    def step(acc, o):
        size, op = o["len"], o["op"]
        gap = op == "N"
        match = op.isin("M", "=", "X")
        entry = F.array(F.struct(acc["r"].alias("start0"), (acc["r"] + size).alias("end0"),
                                 acc["m"].alias("left"), F.lit(0).alias("right")))
        grown = F.transform(acc["b"], lambda e, i: F.when(
            i == F.size(acc["b"]) - 1, e.withField("right", e["right"] + F.when(match, size).otherwise(0))
        ).otherwise(e))
        return F.struct(
            (acc["r"] + F.when(match | op.isin("D", "N"), size).otherwise(0)).cast("bigint").alias("r"),
            F.when(gap, 0).otherwise(acc["m"] + F.when(match, size).otherwise(0)).cast("int").alias("m"),
            F.when(gap, F.concat(acc["b"], entry)).otherwise(grown).cast(_INTRONS).alias("b"))

    zero = F.struct(s.alias("r"), F.lit(0).alias("m"), F.array().cast(_INTRONS).alias("b"))
    found = F.aggregate(cigar_ops(c), zero, step, lambda acc: acc["b"])
    return F.when(F.instr(c, "N") > 0, found).otherwise(F.array().cast(_INTRONS))


_INDELS = "array<struct<pos:bigint,read_pos:int,del_len:int,ins_len:int>>"


def indels(cigar: Column | str, start0: Column | str) -> Column:
    """ARRAY<STRUCT<pos, read_pos, del_len, ins_len>>, one entry per I or D; pos = reference bases before it."""
    c, s = _col(cigar), _col(start0).cast("bigint")

    def step(acc, o):
        size, op = o["len"], o["op"]
        entry = F.array(F.struct(acc["r"].alias("pos"), acc["q"].alias("read_pos"),
                                 F.when(op == "D", size).otherwise(0).alias("del_len"),
                                 F.when(op == "I", size).otherwise(0).alias("ins_len")))
        return F.struct(
            (acc["r"] + F.when(op.isin("M", "=", "X", "D", "N"), size).otherwise(0)).cast("bigint").alias("r"),
            (acc["q"] + F.when(op.isin("M", "=", "X", "I", "S"), size).otherwise(0)).cast("int").alias("q"),
            F.when(op.isin("I", "D"), F.concat(acc["b"], entry)).otherwise(acc["b"]).cast(_INDELS).alias("b"))

    zero = F.struct(s.alias("r"), F.lit(0).alias("q"), F.array().cast(_INDELS).alias("b"))
    found = F.aggregate(cigar_ops(c), zero, step, lambda acc: acc["b"])
    return F.when(c.rlike("[ID]"), found).otherwise(F.array().cast(_INDELS))


_RUNS = "array<struct<ref_start:bigint,read_start:int,len:int,deleted:boolean>>"


def reference_runs(cigar: Column | str, start0: Column | str) -> Column:
    """ARRAY<STRUCT<ref_start, read_start, len, deleted>>: aligned runs and deletions in order."""
    c, s = _col(cigar), _col(start0).cast("bigint")

    def step(acc, o):
        size, op = o["len"], o["op"]
        match = op.isin("M", "=", "X")
        entry = F.array(F.struct(acc["r"].alias("ref_start"), acc["q"].alias("read_start"), size.alias("len"),
                                 (op == "D").alias("deleted")))
        return F.struct(
            (acc["r"] + F.when(match | op.isin("D", "N"), size).otherwise(0)).cast("bigint").alias("r"),
            (acc["q"] + F.when(match | op.isin("I", "S"), size).otherwise(0)).cast("int").alias("q"),
            F.when(match | (op == "D"), F.concat(acc["b"], entry)).otherwise(acc["b"]).cast(_RUNS).alias("b"))

    zero = F.struct(s.alias("r"), F.lit(0).alias("q"), F.array().cast(_RUNS).alias("b"))
    return F.aggregate(cigar_ops(c), zero, step, lambda acc: acc["b"])
