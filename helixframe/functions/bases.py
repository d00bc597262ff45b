"""Base and quality string expressions.

Quality strings are taken apart, put together and summed as whole Arrow columns: a lambda over the letters of each string costs
more than all else a job over reads does.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_PHRED_OFFSET = 33


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def letters_of_texts():
    """Helper for the tasks: code points of all texts of a column in a row, and where each text begins (nulls are empty)."""
    def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        values = texts.fill_null("")
        if len(values) and not pa.types.is_large_string(values.type):
            begins = np.frombuffer(values.buffers()[1], dtype="<i4", count=values.offset + len(values) + 1)[values.offset:].astype(np.int64)
            raw = np.frombuffer(values.buffers()[2] or b"", dtype=np.uint8)[begins[0]:begins[-1]]
            if not (raw & 0x80).any():  # one byte for each letter
                return raw.astype(np.int64), begins - begins[0]
        texts = values.to_pylist()
        sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        return np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])
    return letters


def phred_decode(qualities: Column | str) -> Column:
    """Phred+33 text to ARRAY<INT>."""
    letters, offset = letters_of_texts(), _PHRED_OFFSET

    @F.arrow_udf("array<int>")
    def decode(texts: pa.Array) -> pa.Array:
        codes, starts = letters(texts)
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(codes - offset, pa.int32()), mask=texts.is_null() if texts.null_count else None)

    return decode(_col(qualities))


def phred_encode(values: Column | str) -> Column:
    """Phred+33 text of ARRAY<INT>; null elements are left out."""
    offset = _PHRED_OFFSET

    @F.arrow_udf("string")
    def encode(lists: pa.Array) -> pa.Array:
        flat = lists.flatten()
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        if flat.null_count:
            there = flat.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(there)])[np.concatenate([[0], np.cumsum(sizes)])]
            flat = flat.drop_null()
        else:
            ends = np.concatenate([[0], np.cumsum(sizes)])
        codes = flat.to_numpy(zero_copy_only=False).astype(np.int64) + offset
        if not lists.null_count and not ((codes < 0) | (codes > 127)).any():
            return pa.StringArray.from_buffers(len(lists), pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(codes.astype(np.uint8).tobytes()))
        whole = np.where(codes < 0, 0x10FFFF, codes & 0xFF).astype("<u4").tobytes().decode("utf-32-le")  # as chr() has it: nothing for less than 0
        texts = [whole[i:j].replace("\U0010ffff", "") for i, j in zip(ends, ends[1:])]
        return pa.array([t if there else None for t, there in zip(texts, lists.is_valid().to_pylist())], pa.string())

    return encode(_col(values))


def error_prob(quality: Column | str) -> Column:
    return F.pow(F.lit(10.0), -_col(quality) / F.lit(10.0))


def quality_sum(qualities: Column | str, floor: int = 15) -> Column:
    """Sum of the base qualities that reach ``floor``."""
    letters, offset = letters_of_texts(), _PHRED_OFFSET

    @F.arrow_udf("int")
    def total(texts: pa.Array) -> pa.Array:
        codes, starts = letters(texts)
        value = codes - offset
        running = np.concatenate([[0], np.cumsum(np.where(value >= floor, value, 0))])
        return pa.array(running[starts[1:]] - running[starts[:-1]], pa.int32(), mask=texts.is_null().to_numpy(zero_copy_only=False))

    return total(_col(qualities))


def reverse_complement(sequence: Column | str) -> Column:
    return F.reverse(F.translate(_col(sequence), "ACGTacgt", "TGCAtgca"))


def contig_style(contig: Column | str, style: str) -> Column:
    """Rename contigs to ``ucsc`` (chr1, chrM) or ``grc`` (1, MT)."""
    c = _col(contig)
    bare = F.regexp_replace(c, "^chr", "")
    if style == "grc":
        return F.when(bare == "M", F.lit("MT")).otherwise(bare)
    if style == "ucsc":
        return F.concat(F.lit("chr"), F.when(bare == "MT", F.lit("M")).otherwise(bare))
    raise ValueError("style is 'ucsc' or 'grc'")
