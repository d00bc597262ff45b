"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame operations only.

Test items are short and documents long, so a MinHash of the document would say little about the item. Items are
partitioned by size; each partition has a sketch length, and an item's sketch is that many of the smallest hashes of its
shingles. Documents are searched for sketch hashes. With a sketch of ``n - need + EXTRA`` of the ``n`` hashes of an item, a
document that holds ``need`` shingles of it holds ``EXTRA`` sketch hashes at least: nothing is missed, and few others are
hit. Documents with fewer shingles than ``need`` are out by their size. Candidates are verified by the exact shared
shingles, as text.

Edge cases: words end at space and at characters 9 to 13, A-Z count in lower case; a text with fewer than five words is one
shingle of all its words; null and empty texts have none and match nothing; repeated rows of documents match each, of items
once; empty tables give an empty result; other columns are ignored. A null item_id matches as an item of its own.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.runtime import fits, lookup_join, stage

#: Words of a shingle; per cent of an item's shingles that a document must hold; sketch hashes it then holds.
WIDTH = 5
PERCENT = 80
EXTRA = 3
SPACE = "\t\n\x0b\x0c\r "
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows up to which sketches or candidates are broadcast.
BROADCAST = 200_000


def _words(text: Column) -> Column:
    plain = F.translate(F.coalesce(text, F.lit("")), SPACE + UPPER, " " * len(SPACE) + UPPER.lower())
    return F.array_remove(F.split(plain, " "), "")


def _shingles(words: Column, of) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (WIDTH - 1), F.lit(1)))
    return F.when(F.size(words) > 0, F.transform(starts, lambda i: of(F.slice(words, i, WIDTH)))) \
            .otherwise(F.array().cast("array<bigint>" if of is F.xxhash64 else "array<string>"))


def _text_shingles(words: Column) -> Column:
    return F.array_distinct(_shingles(words, lambda s: F.array_join(s, " ")))


def item_sketches(items: DataFrame) -> DataFrame:
    """item, item_id, need, h, enough: the sketch hashes of each item, and how many of them a match holds."""
    hashed = items.select("item", "item_id", _words(F.col("text")).alias("w")).where(F.size("w") > 0) \
                  .select("item", "item_id", F.sort_array(F.array_distinct(_shingles(F.col("w"), F.xxhash64))).alias("hs"))
    n = F.size("hs")
    # partitions double in size; the sketch length of a partition is that of its largest item
    upper = F.pow(F.lit(2), F.ceil(F.log2(n))).cast("int")
    need = lambda x: F.ceil(x * PERCENT / 100).cast("int")
    length = F.least(n, upper - need(upper) + EXTRA)
    sized = hashed.select("item", "item_id", need(n).alias("need"), "hs", length.alias("k"), n.alias("n"))
    return sized.select("item", "item_id", "need", F.greatest(F.lit(1), F.col("k") - (F.col("n") - F.col("need"))).alias("enough"),
                        F.explode(F.slice("hs", 1, F.col("k"))).alias("h"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_item, n_shared, containment, key: one row per document row and item it holds.

    ``key`` is a hash of doc_id and text, the same for repeated rows.
    """
    named = items.select("item_id", "text").distinct().withColumn("item", F.xxhash64("item_id", "text"))
    sketch = stage(item_sketches(named), "sketches")
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    words = keyed.select("key", _words(F.col("text")).alias("w")).where(F.size("w") > 0)
    hashed = words.select("key", F.greatest(F.size("w") - (WIDTH - 1), F.lit(1)).alias("size"),
                          F.explode(_shingles(F.col("w"), F.xxhash64)).alias("h"))
    hits = lookup_join(hashed, sketch, ["h"], "inner", ["key"], BROADCAST).where(F.col("size") >= F.col("need"))
    found = stage(hits.groupBy("key", "item").agg(F.countDistinct("h").alias("held"), F.first("enough").alias("enough"), F.first("need").alias("need"))
                  .where(F.col("held") >= F.col("enough")).select("key", "item", "need"), "candidates")
    # words are a column of their own: written into the shingles' lambda they would be split anew for each shingle
    whole = named.select("item", "item_id", _words(F.col("text")).alias("w")).select("item", "item_id", _text_shingles(F.col("w")).alias("item_shingles"))
    wanted = found.select("key").distinct()
    held = keyed.join(F.broadcast(wanted), "key") if fits(wanted, BROADCAST) else keyed.join(wanted, "key")
    held = held.select("key", "doc_id", _words(F.col("text")).alias("w")).select("key", "doc_id", _text_shingles(F.col("w")).alias("doc_shingles"))
    pairs = lookup_join(found, whole, ["item"], "inner", ["key"], BROADCAST)
    shared = F.size(F.array_intersect("doc_shingles", "item_shingles")).cast("long")
    return held.join(pairs, "key").select(
        "doc_id", "item_id", F.size("item_shingles").cast("long").alias("n_item"), shared.alias("n_shared"), "need", "key") \
        .where(F.col("n_shared") >= F.col("need")).select(
        "doc_id", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"), "key")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold no item."""
    bad = stage(contaminated(docs.select("doc_id", "text"), items).select("key").distinct(), "contaminated")
    own = F.xxhash64("doc_id", "text")
    if fits(bad, BROADCAST):
        bad = F.broadcast(bad)
    return docs.join(bad, own == bad["key"], "left_anti")
