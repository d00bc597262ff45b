"""Exact duplicates by progressive refinement: rows are grouped by length, then by prefix hash, then by full hash.

Texts are equal when they are identical after white space (space and characters 9 to 13) is deleted. The first scan
notes the length and the hash of a prefix of each text; groups of one length split by prefix hash, on these two numbers alone. The
second scan hashes whole texts, but only those of a (length, prefix) group with more than one row. Which groups these are is told to the tasks by a
bitmap of at most ``MOST_BITS`` bits, built in Spark with 32 bits a group: where it says yes in error (one time in 32, more often
for very many groups) a text is hashed for nothing and stays alone, so the bitmap never decides a result and texts are never shuffled.

Of equal texts the row with the most code points in the original text stays, then that with the smallest doc_id (a null one
comes last); of rows equal in both, exactly one stays. A group that holds more than a thousandth of all rows is
joined by broadcast (there are a thousand at most), all others by a shuffle, so no task gets a large group.

Edge cases: null text is empty, and all texts without characters are one group; a null doc_id stays null in ``keep_id``; an
empty table gives an empty result; other columns are ignored (``exact_duplicates``) or passed (``drop_duplicates``).
"""
from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.runtime import lookup_join, stage

#: Fixed value: white space that does not count.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes of the prefix; bits of the bitmap for a group, and of the whole bitmap at most; rows of one piece of it.
PREFIX = 64
BITS_PER_GROUP = 32
MOST_BITS = 1 << 29
_PIECE = 1 << 15
#: A group with more than this part of all rows is broadcast.
HOT_PART = 1000


def _bare(text: str | None) -> bytes:
    return text.encode("utf-8", "replace").translate(None, SPACE) if text else b""


def _prefix_key(bare: bytes) -> int:
    """64 bits of the length and the first bytes."""
    return int.from_bytes(hashlib.blake2b(bare[:PREFIX], digest_size=8, salt=len(bare).to_bytes(8, "little")).digest(), "little", signed=True)


def _marks():
    @F.pandas_udf("n long, key long")
    def marks(texts: pd.Series) -> pd.DataFrame:
        bare = [_bare(t) for t in texts]
        return pd.DataFrame({"n": [len(b) for b in bare], "key": [_prefix_key(b) for b in bare]})

    return marks.asNondeterministic()


def _refined(docs: DataFrame) -> DataFrame:
    """key of every group of equal length and equal prefix hash that has more than one row."""
    marks = stage(docs.select(_marks()("text").alias("m")).select("m.*").groupBy("n", "key").agg(F.count("*").alias("rows")), "text-marks")
    lengths = marks.groupBy("n").agg(F.sum("rows").alias("rows")).where("rows > 1").select("n")
    return lookup_join(marks, lengths, ["n"], "left_semi", ["key"]).where("rows > 1").select("key")


def _bitmap(keys: DataFrame) -> tuple[int, list[tuple[int, bytes]]]:
    """Number of bits (a power of two), and the pieces of the bitmap in which the bits of ``keys`` are set."""
    wanted, bits = BITS_PER_GROUP * max(1, keys.count()), _PIECE
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    at = keys.select(F.col("key").bitwiseAND(bits - 1).alias("at"))
    pieces = at.groupBy(F.expr(f"at div {_PIECE}").alias("piece")).agg(F.bitmap_construct_agg(F.col("at") % _PIECE).alias("set"))
    return bits, [(r["piece"], bytes(r["set"])) for r in pieces.collect()]  # at most MOST_BITS / 8 bytes


def _full_hash(bitmap, every: bool):
    bits = bitmap.value[0]

    @F.pandas_udf("n long, grouped boolean, sha binary")
    def full(texts: pd.Series) -> pd.DataFrame:
        pieces = dict(bitmap.value[1])
        rows = []
        for text in texts:
            bare = _bare(text)
            at = _prefix_key(bare) & (bits - 1)
            piece = pieces.get(at // _PIECE)
            grouped = piece is not None and bool(piece[at % _PIECE // 8] >> at % 8 & 1)
            rows.append((len(bare), grouped, hashlib.sha256(bare).digest() if grouped or every else None))
        return pd.DataFrame(rows, columns=["n", "grouped", "sha"])

    return full.asNondeterministic()


def _with_groups(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """``rows`` with their group, where they have one; both have ``sha``. Large groups are few and broadcast."""
    large = f"group_size > {total // HOT_PART}"
    hot = F.broadcast(groups.where(large))  # fewer than HOT_PART rows
    alone = rows.where("not grouped").join(groups.where("false"), "sha", "left")
    with_hot = rows.where("grouped").join(hot, "sha")
    rest = rows.where("grouped").join(hot.select("sha"), "sha", "left_anti").join(groups.where(f"not ({large})"), "sha", "left")
    return alone.unionByName(with_hot).unionByName(rest)


def exact_duplicates(docs: DataFrame, carry: Column | None = None, every_hash: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    ``text_sha256`` is the hash of the text without white space where the refinement came to need it, else null; with
    ``every_hash`` it is there for every row. ``carry`` is a column to take along as ``carried``.
    """
    spark = docs.sparkSession
    narrow = docs.select("doc_id", "text", (F.lit(None).cast("int") if carry is None else carry).alias("carried"))
    bitmap = spark.sparkContext.broadcast(_bitmap(stage(_refined(narrow), "prefix-groups")))
    seen = narrow.select("doc_id", "carried", F.length(F.coalesce("text", F.lit(""))).alias("chars"), _full_hash(bitmap, every_hash)("text").alias("f"))
    rows = stage(seen.select("doc_id", "carried", "chars", "f.grouped", "f.sha", F.monotonically_increasing_id().alias("uid")), "text-hashes")
    best = F.min(F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "uid"))
    groups = stage(rows.where("grouped").groupBy("sha").agg(best.alias("b"), F.count("*").alias("group_size")).where("group_size > 1")
                   .select("sha", F.col("b.doc_id").alias("keep_id"), F.col("b.uid").alias("keep_uid"), "group_size"), "equal-texts")
    alone = F.col("keep_uid").isNull()
    return _with_groups(rows, groups, rows.count()).select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("keep_uid") == F.col("uid"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "carried")


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, one of each group of equal texts, with the columns they came with."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return exact_duplicates(docs, row).where("kept").select("carried.*")
