"""SAM flag tests as Column expressions."""
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the SAM format.
FLAG_BITS = {
    "paired": 0x1, "proper_pair": 0x2, "unmapped": 0x4, "mate_unmapped": 0x8, "reverse": 0x10,
    "mate_reverse": 0x20, "first_in_pair": 0x40, "second_in_pair": 0x80, "secondary": 0x100,
    "qc_fail": 0x200, "duplicate": 0x400, "supplementary": 0x800,
}


def sam_flag_is(name: str, flag: Column | str = "flag") -> Column:
    return _col(flag).bitwiseAND(FLAG_BITS[name]) != 0


def has_all(bits: int, flag: Column | str = "flag") -> Column:
    return _col(flag).bitwiseAND(bits) == bits


def has_none(bits: int, flag: Column | str = "flag") -> Column:
    return _col(flag).bitwiseAND(bits) == 0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
