"""N-gram Jaccard join of documents by a size-aware heavy-light search.

The set of a document is its distinct word shingles. Two sets with a Jaccard similarity of ``PERCENT`` share ``need`` =
ceil(PERCENT % of the larger) shingles, so, in any order common to all sets, they share k of their first ``n - need + k``.

* Small (light) sets enumerate the subsets of two among those, and meet where they have a subset in common.
* Large (heavy) sets scan the inverted lists of their first ``n - need + 1`` shingles; small sets are on these lists too, for
  the large ones to find.

The boundary between small and large is where the subsets begin to cost more than the lists, as measured on the corpus. The
order puts shingles rare in the corpus first, by a table of counts of fixed size; it only makes lists short, any order is right.

Most prefix shingles are on a list of their own. Which are not is told to the tasks by a bitmap of bounded size, so that lists of
one member are never written. Two bounds leave out pairs that cannot link, before they are made: a pair that meets at places i and j of its
prefixes shares no more than what follows there, or else it has met before on another list; and of two sets, the one whose prefix
ends first in the common order shares none of its prefix shingles that no other prefix has. A third bound leaves out most other pairs before
their sets are moved: each set has a sketch, a bitmap of about four bits a shingle, and a bit that only one of two sketches has
stands for a shingle that only this set has. All bounds are exact; the rest is compared shingle by shingle.

Lists are not expanded into pairs. Equal sets are one class from the start. In some rounds every list names a few hubs, the
other members are compared with these, and classes that link become one component; then only members of different components
are left to compare, and all of those are. So a large group of near copies costs its size times the few members that link
to no hub, not the square of its size, and no link between different sets that matters to a component is missed.

Edge cases: null text, or text without words, has an empty set and links with nothing; a text with fewer than five words has
one shingle, the whole sequence; rows with a null doc_id take part but give no component its name; repeated rows are
equal sets; an empty table gives an empty result; other columns are ignored. Shingles are compared by 64-bit hashes, sets
that are taken for equal by 128 bits more.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.bitmaps import MOST_BITS, bitmap_of, is_set
from helixframe.llm.words import WordHashes, mixed
from helixframe.runtime import drop_stage, lookup_join, stage

PERCENT = 80
#: Shingles counted together in a task; slots of the table of counts that the order goes by, and those of a piece of it; largest small set considered.
CHUNK = 1_000_000
SLOTS = 1 << 24
_PIECE = 1 << 15
LARGEST_SMALL = 64
#: Bits, and numbers, of a part of the bitmap of shared lists.
_BUCKET = 1 << 22
#: Rows up to which keys are broadcast.
BROADCAST = 200_000


def need(n):
    """Shingles a set of ``n`` shares at least with any set it links with."""
    return -(-PERCENT * n // 100)


def _surveyed(docs: DataFrame) -> DataFrame:
    """h, c: shingles met more than once in a chunk, with their count there; n, scan, pairs: costs of small sets by size."""
    def survey(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, held, size = WordHashes(), [], 0

        def flush():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            costs: dict[int, list[int]] = {}
            for s in held:
                if 2 <= len(s) <= LARGEST_SMALL:
                    lists = np.sort(c[np.searchsorted(h, s)])
                    k = len(s) - need(len(s)) + 2
                    cost = costs.setdefault(len(s), [0, 0])
                    cost[0] += int(lists[:k - 1].sum())
                    cost[1] += k * (k - 1) // 2
            many = c > 1
            return pd.concat([pd.DataFrame({"h": h[many].view("int64"), "c": c[many]}),
                              pd.DataFrame([(n, *x) for n, x in costs.items()], columns=["n", "scan", "pairs"])]).astype(
                {x: "Int64" for x in ("h", "c", "n", "scan", "pairs")}).reindex(columns=["h", "c", "n", "scan", "pairs"])

        for batch in batches:
            for text in batch["text"]:
                held.append(words.shingles(text))
                size += len(held[-1])
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return docs.select("text").mapInPandas(survey, "h long, c long, n long, scan long, pairs long")


def slots_of(s: np.ndarray) -> np.ndarray:
    return ((s >> np.uint64(24)) & np.uint64(SLOTS - 1)).astype(np.int64)


def _levels(counted: DataFrame) -> np.ndarray:
    """One byte for each slot: 0, or one more than the logarithm of how often its shingles (h, c) were counted.

    A slot is shared by a few shingles of a large corpus, which then seem more frequent than they are. That only changes the order.
    """
    slot = F.shiftrightunsigned("h", 24).bitwiseAND(SLOTS - 1)
    pieces = counted.groupBy(slot.alias("slot")).agg(F.sum("c").alias("c")).select(
        (F.col("slot") / _PIECE).cast("int").alias("piece"), (F.col("slot") % _PIECE).cast("int").alias("at"), (1 + F.floor(F.log2("c"))).cast("int").alias("level"))

    def table(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(_PIECE, dtype=np.uint8)
        out[rows["at"].to_numpy()] = rows["level"].to_numpy()
        return pd.DataFrame({"piece": [key[0]], "levels": [out.tobytes()]})

    levels = np.zeros(SLOTS, dtype=np.uint8)
    for r in pieces.groupBy("piece").applyInPandas(table, "piece int, levels binary").toLocalIterator():  # SLOTS bytes
        levels[r["piece"] * _PIECE:(r["piece"] + 1) * _PIECE] = np.frombuffer(r["levels"], dtype=np.uint8)
    return levels


def boundary(costs: list[tuple[int, int, int]]) -> int:
    """Size up to which sets are small: where enumerating them and scanning for the rest is cheapest. ``costs``: n, scan, pairs."""
    best, at, total = 0, 0, 0
    for n, scan, pairs in sorted(costs):
        total += pairs - scan
        if total < best:
            best, at = total, n
    return at


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, k1, k2: 128 bits that stand for the row's doc_id and text."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", "doc_id", F.lit(1)).alias("k2"))


def sketch_of(s: np.ndarray) -> bytes:
    """Bitmap of the set's shingles by their last bits; a power of two of bits, four to eight for each shingle."""
    bits = 32
    while bits < 4 * len(s):
        bits *= 2
    out = np.zeros(bits, dtype=bool)
    out[(s & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


def most_shared(a: bytes, b: bytes, n: int, m: int) -> int:
    """No fewer shingles than sets of ``n`` and ``m`` with these sketches share."""
    x, y = (np.frombuffer(v, dtype=np.uint8) for v in (a, b))
    while len(x) != len(y):  # the longer one is folded: its halves are the same bits but one
        x, y = (x[:len(x) // 2] | x[len(x) // 2:], y) if len(x) > len(y) else (x, y[:len(y) // 2] | y[len(y) // 2:])
    return min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))


def _signatures(docs: DataFrame, levels, small: int) -> DataFrame:
    """doc_id, k1, k2, n, set (128 bits), lists (shingles of inverted lists, in the common order), subsets (keys of subsets of two),
    end (rank and shingle of the last one on lists, as numbers in order), sketch, uid."""
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for batch in batches:
            rows = []
            for doc_id, k1, k2, text in zip(batch["doc_id"], batch["k1"], batch["k2"], batch["text"]):
                s = words.shingles(text)
                n = len(s)
                if not n:
                    rows.append((doc_id, k1, k2, 0, None, None, None, None, None, None))
                    continue
                order = levels.value[slots_of(s)]
                k = n - need(n) + 2
                places = np.argsort(order, kind="stable")[:k]
                first, last = s[places], places[max(0, k - 2)]
                subsets = b""
                if 2 <= n <= small:
                    a, b = np.triu_indices(len(first), 1)
                    subsets = np.unique(mixed(np.minimum(first[a], first[b]) * np.uint64(0x9E3779B97F4A7C15) + np.maximum(first[a], first[b])) | np.uint64(1)).tobytes()
                whole = mixed(s + np.uint64(1)).sum(dtype="uint64"), mixed(s ^ np.uint64(0x5BD1E995)).sum(dtype="uint64")
                # the last bit tells lists of shingles from subsets; two shingles that share a list by this cost a comparison more
                lists = (first[:max(1, k - 1)] & ~np.uint64(1)).tobytes()
                rows.append((doc_id, k1, k2, n, np.array(whole).tobytes(), lists, subsets, int(order[last]), int(s[last]) - (1 << 63), sketch_of(s)))
            frame = pd.DataFrame(rows, columns=["doc_id", "k1", "k2", "n", "set", "lists", "subsets", "end_rank", "end", "sketch"])
            yield frame.astype({"end_rank": "Int64", "end": "Int64"})

    rows = _keyed(docs).withColumn("doc_id", F.col("doc_id").cast("long").cast("string"))
    signed = rows.mapInPandas(sign, "doc_id string, k1 long, k2 long, n int, set binary, lists binary, subsets binary, "
                               "end_rank long, end long, sketch binary")
    return signed.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("uid", F.monotonically_increasing_id())


def _entries(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All numbers of a binary column, the row each is from, and its place there."""
    texts = batch.column(column).to_pylist()
    sizes = np.array([len(t) // 8 for t in texts], dtype=np.int64)
    rows = np.repeat(np.arange(len(texts)), sizes)
    places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.frombuffer(b"".join(texts), dtype=np.int64), rows, places


def _shared_bits(entries: DataFrame, total: int, kept=lambda batch: batch) -> np.ndarray:
    """Bitmap (see ``is_set``) of the numbers that ``entries`` (lists, subsets) hold more than once; ``total``: how many they hold.
    ``kept`` gives the rows of a batch that count, so that one Python process a task does.

    Only 32 bits of a number are moved, to the task of its part of the bitmap, and once for a chunk. A bit set by error costs work.
    """
    bits = _PIECE
    while bits < min(2 * total, MOST_BITS):
        bits *= 2
    buckets = 1
    while buckets * _BUCKET < max(bits, total) and buckets < bits >> 3:
        buckets *= 2
    width = bits // buckets

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            keys = keys.view(np.uint64)
            place = (keys >> np.uint64(8)) & np.uint64(bits - 1)
            bucket = (place // np.uint64(width)).astype(np.int64)
            mark = (place % np.uint64(width) + (keys >> np.uint64(36)) * np.uint64(width)).astype(np.uint32)
            order = np.lexsort((mark, bucket))
            bucket, mark, many = bucket[order], mark[order], counts[order] > 1
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            parts = list(zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)]))
            return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.array([mark[x:y].tobytes() for x, y in parts], pa.binary()),
                                               pa.array([mark[x:y][many[x:y]].tobytes() for x, y in parts], pa.binary())], ["bucket", "marks", "many"])

        for batch in map(kept, batches):
            for column in ("lists", "subsets"):
                held.append(_entries(batch, column)[0])
                size += len(held[-1])
            if size >= CHUNK:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        found, counts = np.unique(np.concatenate([np.frombuffer(m, dtype=np.uint32) for m in group["marks"]]), return_counts=True)
        many = np.concatenate([found[counts > 1], *[np.frombuffer(m, dtype=np.uint32) for m in group["many"]]])
        field = np.zeros(width, dtype=bool)
        field[many & np.uint32(width - 1)] = True
        return pd.DataFrame({"bucket": [key[0]], "bits": [np.packbits(field, bitorder="little").tobytes()]})

    out = np.zeros(bits // 8, dtype=np.uint8)
    built = entries.mapInArrow(marks, "bucket long, marks binary, many binary").groupBy("bucket")
    for row in built.applyInPandas(build, "bucket long, bits binary").toLocalIterator():  # at most MOST_BITS / 8 bytes
        out[row["bucket"] * (width // 8):(row["bucket"] + 1) * (width // 8)] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def _list_members(signed: DataFrame, classes: DataFrame, small: int) -> DataFrame:
    """list, place, uid, n, on, lone, end_rank, end, small, light: the entries of all lists that compare anything, of one row of each class.

    ``on`` counts the lists the set shares, ``lone`` its prefix shingles that are in no other prefix (at least; a bit set by error hides some).
    The rows of the classes are told by a bitmap, so that no list is moved for it; a copy that passes by error is a member like any other.
    """
    spark = signed.sparkSession
    first = spark.sparkContext.broadcast(bitmap_of(classes.select(F.xxhash64("class").alias("key"))))

    def of_classes(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(is_set(first.value, batch.column("key").to_numpy())))

    held = signed.where("n > 0").withColumn("key", F.xxhash64("uid"))
    total = signed.agg(F.coalesce(F.sum(F.octet_length("lists") + F.octet_length("subsets")), F.lit(0))).first()[0] // 8
    bitmap = spark.sparkContext.broadcast(_shared_bits(held.select("lists", "subsets", "key"), total, of_classes))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in map(of_classes, batches):
            (lists, row, place), (subsets, row2, place2) = _entries(batch, "lists"), _entries(batch, "subsets")
            here, here2 = is_set(bitmap.value, lists), is_set(bitmap.value, subsets)
            lone = np.bincount(row[~here], minlength=batch.num_rows)
            on = np.bincount(row[here], minlength=batch.num_rows) + np.bincount(row2[here2], minlength=batch.num_rows)
            rows = np.concatenate([row[here], row2[here2]])
            of = lambda c: batch.column(c).to_numpy()[rows]
            columns = {"list": np.concatenate([lists[here], subsets[here2]]), "place": np.concatenate([place[here], place2[here2]]).astype(np.int32),
                       "uid": of("uid"), "n": of("n"), "on": on[rows].astype(np.int32), "lone": lone[rows].astype(np.int32), "end_rank": of("end_rank"), "end": of("end")}
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], list(columns))

    light = F.col("list").bitwiseAND(1) == 1
    passed = stage(held.select("uid", "n", "lists", "subsets", "end_rank", "end", "key").mapInArrow(entries, "list long, place int, uid long, n int, on int, lone int, end_rank long, end long"), "list-entries")
    shared = stage(passed.groupBy("list").agg(F.count("*").alias("size"), F.max("n").alias("longest")).where("size > 1"), "shared-lists")
    # a list with small members only that meet by their subsets compares nothing
    compared = shared.where(light | (F.col("longest") > small) | (F.col("longest") < 2)).select("list")
    members = stage(passed.join(compared, "list", "left_semi").withColumns({"small": F.expr(f"n between 2 and {small}"), "light": light}), "list-members")
    drop_stage(passed)
    drop_stage(shared)
    return members


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node) of the connected components of ``edges`` (u, v), by large and small stars in turn."""
    edges = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stage(large, "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(least, "u")
        edges = stage(linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = now


def _shared_shingles():
    @F.pandas_udf("long")
    def shared(a: pd.Series, b: pd.Series) -> pd.Series:
        out, last, one = np.empty(len(a), dtype=np.int64), None, None
        for k, (x, y) in enumerate(zip(a, b)):
            if x is not last:
                last, one = x, np.frombuffer(x, dtype=np.uint64)
            other = np.frombuffer(y, dtype=np.uint64)
            few, many = (one, other) if len(one) <= len(other) else (other, one)
            at = np.searchsorted(many, few)
            out[k] = np.count_nonzero(many[np.minimum(at, len(many) - 1)] == few)
        return pd.Series(out)

    return shared.asNondeterministic()


def _most_shared():
    @F.pandas_udf("long")
    def most(a: pd.Series, b: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        return pd.Series([most_shared(*x) for x in zip(a, b, n, m)], dtype="int64")

    return most.asNondeterministic()


def _with_sides(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """``pairs`` (u, v) with that column of both, and their sizes. Only what a pair names is moved."""
    for name in ("u", "v"):
        wanted = pairs.select(F.col(name).alias("uid")).distinct()
        side = sets.join(wanted, "uid", "left_semi").select(F.col("uid").alias(name), F.col(column).alias(f"{column}_{name}"), F.col("n").alias(f"n_{name}"))
        pairs = pairs.join(side, name)
    return pairs


def _sets(docs: DataFrame, signed: DataFrame, pairs: DataFrame) -> DataFrame:
    """uid, n, s: sorted shingles of the sets in ``pairs``, made from the texts anew."""
    named = pairs.select("u").unionByName(pairs.select(F.col("v").alias("u"))).select(F.col("u").alias("uid")).distinct()
    wanted = stage(signed.select("uid", "n", "k1", "k2").join(named, "uid", "left_semi"), "wanted-sets")
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(wanted.select(F.col("k1").alias("key"))))

    def shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = WordHashes()
        for batch in batches:
            mine = batch[is_set(bitmap.value, batch["k1"].to_numpy(np.int64))]
            yield pd.DataFrame({"k1": mine["k1"], "k2": mine["k2"], "s": [words.shingles(t).tobytes() for t in mine["text"]]})

    made = _keyed(docs).select("k1", "k2", "text").mapInPandas(shingles, "k1 long, k2 long, s binary")
    return stage(made.join(wanted, ["k1", "k2"]).select("uid", "n", "s"), "sets")


def _verified(pairs: DataFrame, signed: DataFrame, docs: DataFrame) -> DataFrame:
    """u, v of the pairs whose sets are similar enough: by their sketches first, then shingle by shingle."""
    def enough(shared):
        return (100 + PERCENT) * shared >= PERCENT * (F.col("n_u") + F.col("n_v"))

    sketched = _with_sides(pairs, signed, "sketch").withColumn("most", _most_shared()("sketch_u", "sketch_v", "n_u", "n_v"))
    near = stage(sketched.where(enough(F.col("most"))).select("u", "v"), "near-pairs")
    if near.isEmpty():
        return near
    sets = _sets(docs, signed, near)
    links = stage(_with_sides(near, sets, "s").withColumn("both", _shared_shingles()("s_u", "s_v")).where(enough(F.col("both"))).select("u", "v").distinct(), "links")
    drop_stage(sets)
    return links


def _may_link(a: str, b: str):
    """The bounds on what the sets of two entries of one list can share, met at their places, leave enough. ``a``, ``b``: structs."""
    x, y = F.col(a), F.col(b)
    most = F.least(x["n"] - F.when(x["light"], 0).otherwise(x["place"]), y["n"] - F.when(x["light"], 0).otherwise(y["place"]))
    before = (x["end_rank"] < y["end_rank"]) | ((x["end_rank"] == y["end_rank"]) & (x["end"] <= y["end"]))
    after = (y["end_rank"] < x["end_rank"]) | ((x["end_rank"] == y["end_rank"]) & (y["end"] <= x["end"]))
    most = F.least(most, F.when(before, x["n"] - x["lone"]).otherwise(x["n"]), F.when(after, y["n"] - y["lone"]).otherwise(y["n"]))
    return (((100 + PERCENT) * most >= PERCENT * (x["n"] + y["n"])) & (100 * F.least(x["n"], y["n"]) >= PERCENT * F.greatest(x["n"], y["n"]))
            & (x["light"] | ~(x["small"] & y["small"])))


_MEMBER = ("uid", "n", "label", "place", "small", "light", "lone", "end_rank", "end")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return lookup_join(members, labels, ["uid"], "left", ["list"], BROADCAST).withColumn("label", F.coalesce("label", "uid"))


def _hub_pairs(members: DataFrame, labels: DataFrame, round_: int) -> DataFrame:
    """u, v: members of a list with a hub of it that they are not in a component with."""
    rows = _labelled(members, labels)
    # first of all the member that is on most lists: an original is on more than its near copies
    order = -F.col("on").cast("long") if round_ == 0 else F.xxhash64("uid", F.lit(round_))
    named = rows.groupBy("list").agg(F.min("label").alias("one"), F.max("label").alias("other"),
                                     F.min(F.struct(order.alias("o"), *_MEMBER)).alias("h")).where("one <> other").select("list", "h")
    return (rows.select("list", F.struct(*_MEMBER).alias("v")).join(named, "list").where("h.uid <> v.uid and h.label <> v.label").where(_may_link("h", "v"))
            .select(F.col("h.uid").alias("u"), F.col("v.uid").alias("v")).distinct())


def _all_pairs_left(members: DataFrame, labels: DataFrame) -> DataFrame:
    """u, v: every two members of a list that are in different components.

    In each list, the members outside its largest component meet all others, so a list that is one component gives nothing.
    """
    rows = _labelled(members, labels)
    sizes = rows.groupBy("list", "label").agg(F.count("*").alias("size"))
    main = sizes.groupBy("list").agg(F.max_by("label", F.struct("size", "label")).alias("main"), F.count("*").alias("labels")).where("labels > 1")
    split = stage(rows.join(main, "list").select("list", "main", F.struct(*_MEMBER).alias("a")), "split-lists")
    others = split.select(F.col("list").alias("of"), F.col("a").alias("b"))
    met = split.where("a.label <> main").join(others, (F.col("list") == F.col("of")) & (F.col("a.label") != F.col("b.label"))
                                              & ((F.col("b.label") == F.col("main")) | (F.col("a.uid") < F.col("b.uid"))) & _may_link("a", "b"))
    return met.select(F.least("a.uid", "b.uid").alias("u"), F.greatest("a.uid", "b.uid").alias("v")).distinct()


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (uid, label; a uid without a row is its own label) after the components of ``links`` have become one each."""
    end = lambda name: labels.select(F.col("uid").alias(name), F.col("label").alias(f"l{name}"))
    edges = links.join(end("u"), "u", "left").join(end("v"), "v", "left").select(F.coalesce("lu", "u").alias("u"), F.coalesce("lv", "v").alias("v"))
    joined = components(edges)
    renamed = joined.select(F.col("node").alias("label"), F.col("label").alias("now"))
    return stage(labels.join(renamed, "label", "left").select("uid", F.coalesce("now", "label").alias("label"))
                 .unionByName(joined.select(F.col("node").alias("uid"), "label")), "labels")


def similar_documents(docs: DataFrame, rounds: int = 1) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, with k1 and k2 (128 bits of doc_id and text), uid (row) and label (component)."""
    docs = docs.select("doc_id", "text")
    survey = stage(_surveyed(docs), "shingle-survey")
    levels = docs.sparkSession.sparkContext.broadcast(_levels(survey.where("h is not null").select("h", "c")))
    costs = survey.where("n is not null").groupBy("n").agg(F.sum("scan"), F.sum("pairs")).collect()  # one row per size up to LARGEST_SMALL
    small = boundary([tuple(r) for r in costs])
    drop_stage(survey)
    signed = stage(_signatures(docs, levels, small), "signatures")
    classes = stage(signed.where("n > 0").groupBy("set", "n").agg(F.min("uid").alias("class")), "classes")
    members, rows = _list_members(signed, classes, small), signed.select("doc_id", "k1", "k2", "uid", "n", "set")
    labels = stage(docs.sparkSession.createDataFrame([], "uid long, label long"), "labels")
    for step in range(rounds + 1):
        pairs = stage(_hub_pairs(members, labels, step) if step < rounds else _all_pairs_left(members, labels), "pairs")
        links = _verified(pairs, signed, docs)
        drop_stage(pairs)
        labels = labels if links.isEmpty() else _merged(labels, links)
        drop_stage(links)
    drop_stage(members)
    of_class = classes.join(labels.select(F.col("uid").alias("class"), "label"), "class", "left").select(
        "set", "n", F.coalesce("label", "class").alias("label"))
    labelled = stage(rows.join(of_class, ["set", "n"], "left").select("doc_id", "k1", "k2", "uid", "n", F.coalesce("label", "uid").alias("label")), "labelled")
    drop_stage(signed)
    named = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return labelled.join(named, "label").select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "k1", "k2", "uid", "label")


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, one of each component: that with the smallest doc_id; texts without words are all kept."""
    key = ["k1", "k2"]
    rows = stage(similar_documents(docs), "components")
    kept = rows.where("n_shingles > 0").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid", *key)).alias("k"),
                                                            F.count("*").alias("size")).where("size > 1").select("label", F.col("k.k1").alias("c1"), F.col("k.k2").alias("c2"))
    grouped = stage(rows.where("n_shingles > 0").join(kept, "label").groupBy(*key).agg(
        F.max((F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2"))).alias("first")), "groups")
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.xxhash64("doc_id", "text").alias("k1"),
                         F.xxhash64("text", "doc_id", F.lit(1)).alias("k2"))
    marked = lookup_join(marked, grouped, key, "left", key, BROADCAST)
    alone = marked.where("first is null").select("_row.*")
    one = marked.where("first").groupBy(*key).agg(F.first("_row").alias("_row")).select("_row.*")
    return alone.unionByName(one)
