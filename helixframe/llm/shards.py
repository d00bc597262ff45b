"""Token shards in training order.

Documents are tokenised and cut into sequences of a fixed number of tokens. A keyed Feistel network, walked along its cycles
until it lands inside the range, permutes the numbers of all sequences: each gets a place in the order without a table of the
permutation. Places are dealt to shards by range, and every shard is a file of records of one fixed size. The global slot of
a record is the number of records in the shards before, which the manifest has, and its own in the shard: a reader finds any
slot by arithmetic and can go on from it.

Texts are tokenised once. A token has a byte at least, so the bytes of an input partition bound its sequences; numbers are
given out by these bounds, and numbers that no sequence takes leave no gap in the slots. The bounds are summed for each input
partition beforehand; a partition that outgrows its bound stops with an error. Tokens are not stored in between, only
shuffled once to their shards. Shards are written under names of their own for each attempt; the manifest of finished tasks
says which ones count.

Edge cases: null or empty text gives no sequence; a null doc_id is kept as null; repeated rows are sequences of their own;
an empty table gives no shard; other columns are ignored.
"""
from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.runtime import scratch_path, stage

#: The public vocabulary, and how its texts are cut into words before merging.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: No doc_id; the record's head.
NO_ID = -(1 << 63)
HEAD = np.dtype([("doc_id", "<i8"), ("part", "<i4"), ("n", "<i4")])


def feistel(index: np.ndarray, size: int, key: str, rounds: int = 6) -> np.ndarray:
    """The slots of ``index`` (0 to size - 1) under the permutation of 0 to size - 1 that ``key`` names."""
    half = max(1, ((max(size, 2) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "little")) for r in range(rounds)]
    out, todo = index.astype("uint64"), np.arange(len(index))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= size]
    return out.astype("int64")


class Tokenizer(dict):
    """Maps a word, to be read with a space in front of it, to its packed ids; holds at most ``bound`` words."""

    def __init__(self, path: str, bound: int = 500_000):
        import tiktoken

        super().__init__()
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("shards", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, dtype="int64")
        self.sizes[list(ranks.values())] = [len(t) for t in ranks]
        self.bound = bound

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.bpe.encode_ordinary(text), dtype="<u2")

    def _learn(self, words: set[str]) -> None:
        """Encodes new words together, and cuts the ids at the words' ends."""
        if len(self) + len(words) > self.bound:
            self.clear()
        new = [w for w in words if w not in self and w]
        self[""] = self._ids(" ").tobytes()
        text = " " + " ".join(new)
        ids = self._ids(text) if new else np.zeros(0, dtype="<u2")
        ends = np.cumsum([1 + len(w.encode()) for w in new])
        cuts = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
        packed, at = ids.tobytes(), 0
        for word, cut in zip(new, (2 * cuts).tolist()):
            self[word] = packed[at:cut]
            at = cut

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text. Words never reach across a single space in front of another character, so texts are cut there."""
        split = [None if "  " in t else t.split(" ") for t in texts]
        out, size, todo = [], 0, set()
        for k, words in enumerate(split):
            if words:
                todo.update(words[1:])
                size += len(words)
            if size > 200_000 or k == len(split) - 1:
                self._learn(todo)
                for text, own in zip(texts[len(out):k + 1], split[len(out):k + 1]):
                    out.append(self._ids(text).tobytes() if own is None else
                               b"".join([self._ids(own[0]).tobytes(), *map(self.__getitem__, own[1:])]))
                size, todo = 0, set()
        return out


_TOKENIZERS: dict[str, Tokenizer] = {}


def _tokenizer(path: str) -> Tokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Tokenizer(path)
    return _TOKENIZERS[path]


def write_shards(docs: DataFrame, folder: str, length: int = 256, per_shard: int = 16384, key: str = "order",
                 ranks: str = RANKS) -> DataFrame:
    """Writes the shards of ``docs``; gives their manifest: shard, path, first (slot), records."""
    spark = docs.sparkSession
    rows = docs.where("text is not null and text <> ''").select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    # reads the columns that ``cut`` reads, so that both see the same input partitions
    bounds = rows.select(F.spark_partition_id().alias("part"), F.ceil(F.octet_length("text") / length).alias("most"), "doc_id")
    bounds = {r["part"]: r["most"] for r in bounds.groupBy("part").agg(F.sum("most").alias("most"), F.count("doc_id")).collect()}  # one row per partition
    total, starts = 0, {}
    for part in sorted(bounds):
        starts[part], total = total, total + bounds[part]
    starts = spark.sparkContext.broadcast(starts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = _tokenizer(ranks), TaskContext.get().partitionId()
        at = first = starts.value.get(part, 0)
        for batch in batches:
            head, bodies = [], []
            for doc_id, packed in zip(batch.column("doc_id").to_pylist(), tokens.encode_all(batch.column("text").to_pylist())):
                for k in range(0, len(packed), 2 * length):
                    body = packed[k:k + 2 * length]
                    head.append((NO_ID if doc_id is None else doc_id, k // (2 * length), len(body) // 2))
                    bodies.append(body.ljust(2 * length, b"\0"))
            if at + len(head) - first > bounds.get(part, 0):
                raise RuntimeError(f"input partition {part} has more than its {bounds.get(part, 0)} sequences")
            slots = feistel(np.arange(at, at + len(head)), total, key)
            at += len(head)
            heads = np.array(head, dtype=HEAD).tobytes()
            records = [heads[k * HEAD.itemsize:(k + 1) * HEAD.itemsize] + body for k, body in enumerate(bodies)]
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(slots // per_shard), pa.array(records, pa.binary())],
                                             names=["slot", "shard", "record"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        done, shard, out, last = [], None, None, -1
        for batch in batches:
            for slot, own, record in zip(*(batch.column(c).to_pylist() for c in ("slot", "shard", "record"))):
                if own != shard:
                    if out is not None:
                        out.close()
                    name, shard = f"shard-{own:08d}-{TaskContext.get().taskAttemptId()}.bin", own
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    done.append([own, f"{folder}/{name}", 0])
                if slot <= last:
                    raise RuntimeError(f"place {slot} follows {last}")
                out.write(record)
                done[-1][2] += 1
                last = slot
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_pandas(pd.DataFrame(done, columns=["shard", "path", "records"]).astype(
            {"shard": "int64", "records": "int64"}), preserve_index=False)

    dealt = rows.mapInArrow(cut, "slot long, shard long, record binary")
    ranged = dealt.repartitionById(max(1, -(-total // per_shard)), F.col("shard").cast("int")).sortWithinPartitions("slot")
    written = stage(ranged.mapInArrow(write, "shard long, path string, records long"), "shards-written")
    return stage(_numbered(written), "shard-manifest")


def _numbered(written: DataFrame, block: int = 4096) -> DataFrame:
    """Adds ``first``, the records of all shards before: summed by block of shards, then inside each block."""
    blocks = written.withColumn("block", F.floor(F.col("shard") / block))
    before = lambda w: F.coalesce(F.sum("records").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = blocks.groupBy("block").agg(F.sum("records").alias("records")).select("block", before(Window.orderBy("block")).alias("ahead"))
    return blocks.join(ahead, "block").select(
        "shard", "path", (F.col("ahead") + before(Window.partitionBy("block").orderBy("shard"))).alias("first"), "records")


def read_shards(manifest: DataFrame, length: int = 256, start: int = 0) -> DataFrame:
    """slot, doc_id, part, n_tokens, crc (of the ids) of every sequence from slot ``start`` on; earlier shards are not opened."""
    dtype = np.dtype([*((n, HEAD.fields[n][0]) for n in HEAD.names), ("ids", "<u2", (length,))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                fs, base = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(base) as file:
                    skip = max(0, start - first)
                    file.seek(skip * dtype.itemsize)
                    records = np.frombuffer(file.read(), dtype=dtype)
                crc = [zlib.crc32(ids[:n].tobytes()) for ids, n in zip(records["ids"], records["n"])]
                doc_id = records["doc_id"].astype("int64")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(first + skip, first + skip + len(records))), pa.array(doc_id, mask=doc_id == NO_ID),
                     pa.array(records["part"].astype("int32")), pa.array(records["n"].astype("int32")), pa.array(crc, pa.int64())],
                    names=["slot", "doc_id", "part", "n_tokens", "crc"])

    from_here = manifest.where(F.col("first") + F.col("records") > start)
    return from_here.repartition(max(1, from_here.count()), "path").mapInArrow(
        read, "slot long, doc_id long, part int, n_tokens int, crc long")


def training_order(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Shards of ``docs`` in the shared folder, read back."""
    folder = scratch_path(spark, "shards")
    if ":" not in folder.split("/")[0]:
        folder = "file://" + folder
    return read_shards(write_shards(docs, folder))
