"""Katz back-off language model: scores of whole texts.

Tokens are words (A-Z in lower case) and one end for each text. Every word of the training texts has its own unigram and its own
bigrams; one class stands for all words they do not hold. Counts are discounted by Good-Turing; what the discounts free goes
to the class of unknown words (unigrams) and to the unigrams not seen behind a word (bigrams), with weights that make every
context sum to one exactly. A token is looked up as a bigram and, where that is unknown, falls back to its unigram.

Texts are read in chunks of about ``CHUNK`` tokens. The ``KNOWN`` most frequent words are told to all tasks and have numbers; other
(rare) words are numbered inside a chunk, which asks the table of counts for theirs. A chunk sends its distinct bigrams with their
counts, packed, to buckets by the hash of the bigram; a bucket adds up the counts of all chunks and returns each chunk the totals
it asked for. So counts are combined before they are shuffled, no bigram gathers rows of its own, and buckets grow in
number, not in size, with the corpus. Only tables bounded by ``KNOWN`` reach the driver; the back-off weights of rare words are
joined to the texts that need them.

Edge cases: null text is empty and has just its end; a null doc_id counts as training; repeated rows are scored each; with
no training text all words are unknown; an empty table gives an empty result; ties in frequency go by hash.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.words import WordHashes, mixed
from helixframe.runtime import drop_stage, stage

CHUNK = 2_000_000
KNOWN = 1 << 18
#: Counts up to DISCOUNTED are discounted; the end, which is no word.
DISCOUNTED = 5
END = np.uint64(0x656E64)
_DOC = np.dtype([("doc_id", "<i8"), ("no_id", "?"), ("held_out", "?"), ("n", "<i4")])
#: Texts of one chunk at most, so that chunk and text together number a row.
_TEXTS = 1 << 20


def _inputs(docs: DataFrame) -> DataFrame:
    rest = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 7
    return docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), (rest == 2).alias("held_out"),
                       F.coalesce("text", F.lit("")).alias("text"))


def word_counts(inputs: DataFrame) -> DataFrame:
    """h, c: training count of every token."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, held, size = WordHashes(), [], 0

        def flush():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pd.DataFrame({"h": h.view("int64"), "c": c})

        for batch in batches:
            for text in batch["text"]:
                held.append(np.append(words.of(text), END))
                size += len(held[-1])
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return inputs.where("not held_out").select("text").mapInPandas(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def good_turing(n: np.ndarray) -> np.ndarray:
    """Discounts of counts 0 to DISCOUNTED (the first is unused) from ``n[r]``, the number of events seen r times.

    Where the counts of counts are too thin to give a ratio inside (0, 1), half a count of each event is set aside instead.
    """
    k, d = DISCOUNTED, np.ones(DISCOUNTED + 1)
    cut = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        ratio = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) if n[r] and cut != 1 else 0.0
        d[r] = ratio if 0 < ratio < 1 else (r - 0.5) / r
    return d


def unigram_model(total: int, low: dict[int, int]) -> tuple[np.ndarray, float, float]:
    """Discounts, factor and rest: a word counted c times has probability c * discount(c) * factor, all unknown ones have the rest.

    ``low`` holds how many words were counted 1 to DISCOUNTED + 1 times; all words and the rest sum to one.
    """
    d = good_turing(np.array([0, *[low.get(r, 0) for r in range(1, DISCOUNTED + 2)]], dtype=float))
    kept = (total - sum(r * low.get(r, 0) * (1 - d[r]) for r in range(1, DISCOUNTED + 1))) / max(1, total)
    rest = max(1 - kept, 1 / (total + 1))
    return d, (1 - rest) / kept / max(1, total) if kept else 0.0, rest


def probabilities(counts: np.ndarray, unigrams: tuple[np.ndarray, float, float]) -> np.ndarray:
    d, factor, rest = unigrams
    return np.where(counts > 0, counts * np.where(counts <= DISCOUNTED, d[np.minimum(counts, DISCOUNTED)], 1.0) * factor, rest)


def _packed(numbers: np.ndarray) -> bytes:
    """Bytes of numbers, first ones first, so that the upper bytes of small numbers compress to nothing."""
    return np.ascontiguousarray(numbers.view("u1").reshape(-1, numbers.dtype.itemsize).T).tobytes()


def _unpacked(data: bytes, dtype: str) -> np.ndarray:
    planes = np.frombuffer(data, dtype="u1").reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _steps(numbers: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as packed differences."""
    return _packed(np.diff(numbers, prepend=np.uint64(0)).astype("<u8"))


def _from_steps(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, "<u8"), dtype="uint64")


def _chunks(inputs: DataFrame, known) -> DataFrame:
    """chunk, docs, ids, rare: packed tokens as numbers; those beyond the known words number the sorted hashes in ``rare``."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, first = WordHashes(), TaskContext.get().partitionId() << 12
        hashes, ids, _, _ = known.value
        docs, own, size, number = [], [], 0, 0

        def flush(number):
            h = np.concatenate(own)
            at = np.minimum(np.searchsorted(hashes, h), max(0, len(hashes) - 1))
            hit = hashes[at] == h if len(hashes) else np.zeros(len(h), dtype=bool)
            numbers = np.empty(len(h), dtype="<u4")
            numbers[hit] = ids[at[hit]]
            rare, which = np.unique(h[~hit], return_inverse=True)
            numbers[~hit] = len(hashes) + which
            return pd.DataFrame({"chunk": [first + number], "docs": [np.array(docs, dtype=_DOC).tobytes()], "ids": [_packed(numbers)], "rare": [_steps(rare)]})

        for batch in batches:
            for doc_id, held_out, text in zip(batch["doc_id"], batch["held_out"], batch["text"]):
                own.append(np.append(words.of(text), END))
                docs.append((0 if doc_id is None else int(doc_id), doc_id is None, held_out, len(own[-1])))
                size += len(own[-1])
                if size >= CHUNK or len(docs) == _TEXTS:
                    yield flush(number)
                    docs, own, size, number = [], [], 0, number + 1
        if docs:
            yield flush(number)

    return inputs.mapInPandas(pack, "chunk long, docs binary, ids binary, rare binary")


def _with_counts(chunks: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """``chunks`` with the counts of their rare words. Words are asked for by buckets of their hash, a chunk's in one row."""
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for chunk, rare in zip(batch["chunk"], batch["rare"]):
                h = _from_steps(rare)
                bucket = (h >> np.uint64(1)) % np.uint64(buckets)
                yield pd.DataFrame([(b, chunk, _steps(h[bucket == b])) for b in np.unique(bucket).tolist()], columns=["bucket", "chunk", "rare"])

    def answer(asked: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        h, c = table["h"].to_numpy("int64").view("uint64"), table["c"].to_numpy("int64")
        order = np.argsort(h)
        h, c, out = h[order], c[order], []
        for rare in map(_from_steps, asked["rare"]):
            at = np.minimum(np.searchsorted(h, rare), max(0, len(h) - 1))
            out.append(_packed((np.where(h[at] == rare, c[at], 0) if len(h) else np.zeros(len(rare))).astype("<u4")))
        return pd.DataFrame({"chunk": asked["chunk"], "bucket": asked["bucket"], "counts": out}).astype({"chunk": "int64", "bucket": "int64"})

    def put(own: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        h = _from_steps(own["rare"].iloc[0])
        bucket, c = (h >> np.uint64(1)) % np.uint64(buckets), np.zeros(len(h), dtype="<u4")
        for b, own_counts in zip(got["bucket"], got["counts"]):
            c[bucket == b] = _unpacked(own_counts, "<u4")
        return own.assign(counts=[_packed(c)])

    requests = chunks.select("chunk", "rare").mapInPandas(ask, "bucket long, chunk long, rare binary")
    table = counts.withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 1), F.lit(buckets)))
    answers = requests.groupBy("bucket").cogroup(table.groupBy("bucket")).applyInPandas(answer, "chunk long, bucket long, counts binary")
    # words that nobody asks for give no rows
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        put, "chunk long, docs binary, ids binary, rare binary, counts binary")


class _Chunk:
    """Texts and distinct bigrams of a chunk with their buckets: the same whenever the chunk is read."""

    def __init__(self, row, known: tuple, buckets: int):
        hashes, ids, by_id, by_count = known
        self.heads, self.ids, rare = np.frombuffer(row.docs, dtype=_DOC), _unpacked(row.ids, "<u4"), _from_steps(row.rare)
        self.known = len(hashes)
        self.hashes = np.concatenate([by_id, rare])
        self.counts = np.concatenate([by_count, _unpacked(row.counts, "<u4").astype("int64")])
        at = int(np.searchsorted(hashes, END))
        end = ids[at] if at < len(hashes) and hashes[at] == END else self.known + np.searchsorted(rare, END)
        before = np.empty(len(self.ids), dtype="uint64")
        before[1:] = self.ids[:-1]
        before[np.cumsum(self.heads["n"]) - self.heads["n"]] = end  # in front of a text
        distinct, self.inverse = np.unique(before << np.uint64(32) | self.ids, return_inverse=True)
        self.w1, self.w2 = (distinct >> np.uint64(32)).astype("int64"), (distinct & np.uint64(0xFFFFFFFF)).astype("int64")
        self.plain = (self.w1 < self.known) & (self.w2 < self.known)
        h1, h2 = self.hashes[self.w1], self.hashes[self.w2]
        self.bucket = (mixed(mixed(h1 * np.uint64(0x9E3779B97F4A7C15) + h2)) % np.uint64(buckets)).astype("int64")
        # by bucket, plain bigrams in front
        self.order = np.argsort(2 * self.bucket + ~self.plain, kind="stable")
        self.borders = np.searchsorted((2 * self.bucket + ~self.plain)[self.order], np.arange(2 * buckets + 1))


def _requests(chunks: DataFrame, known, buckets: int) -> DataFrame:
    """bucket, chunk, the distinct bigrams of the chunk there and their training counts. Bigrams of known words are one number
    (keys); others are the hashes of both words, with which of them are known and how often the second was counted."""
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                x = _Chunk(row, known.value, buckets)
                counts = np.bincount(x.inverse, weights=np.repeat(~x.heads["held_out"], x.heads["n"]), minlength=len(x.w1)).astype("<u4")
                rows = []
                for b in range(buckets):
                    i, j, k = x.borders[2 * b:2 * b + 3]
                    own, rare = x.order[i:j], x.order[j:k]
                    if k > i:
                        w1, w2 = x.w1[rare], x.w2[rare]
                        rows.append((b, row.chunk, _steps((x.w1[own] * x.known + x.w2[own]).astype("uint64")), _packed(counts[x.order[i:k]]),
                                     ((w1 < x.known) + 2 * (w2 < x.known)).astype("u1").tobytes(), _packed(np.where(w1 < x.known, w1.astype("uint64"), x.hashes[w1])),
                                     _packed(np.where(w2 < x.known, w2.astype("uint64"), x.hashes[w2])), _packed(x.counts[w2].astype("<u4"))))
                yield pd.DataFrame(rows, columns=["bucket", "chunk", "keys", "counts", "kinds", "first", "second", "c2"])

    return chunks.mapInPandas(ask, "bucket long, chunk long, keys binary, counts binary, kinds binary, first binary, second binary, c2 binary")


_STATISTICS = [*[f"n{r}" for r in range(1, DISCOUNTED + 2)], "more", "mass"]
_ANSWER = ("chunk long, bucket long, totals binary, w1 int, h1 long, " + ", ".join(f"n{r} long" for r in range(1, DISCOUNTED + 2))
           + ", more long, mass double")


def _contexts(name: str, words: np.ndarray, r: np.ndarray, p: np.ndarray) -> pd.DataFrame:
    """Per context word the counts of counts of the bigrams seen, and the unigram mass behind it."""
    own, which = np.unique(words, return_inverse=True)
    fill = lambda w: np.bincount(which, weights=w, minlength=len(own))
    return pd.DataFrame({name: own, **{f"n{k}": fill(r == k).astype("int64") for k in range(1, DISCOUNTED + 2)},
                         "more": fill(np.where(r > DISCOUNTED, r, 0)).astype("int64"), "mass": fill(p)})


def _answers(requests: DataFrame, known, unigrams) -> DataFrame:
    """Totals for each chunk; per context word (w1: known, h1: hash of another) its statistics."""
    def add(group: pd.DataFrame) -> pd.DataFrame:
        by_count, n = known.value[3], max(1, len(known.value[0]))
        keys, counts = [_from_steps(k) for k in group["keys"]], [_unpacked(c, "<u4").astype("int64") for c in group["counts"]]
        whole = lambda column, dtype: np.concatenate([_unpacked(x, dtype) for x in group[column]])
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(inverse, weights=np.concatenate([c[:len(k)] for k, c in zip(keys, counts)]), minlength=len(distinct)).astype("int64")
        kinds, first, second, c2 = whole("kinds", "u1"), whole("first", "<u8"), whole("second", "<u8"), whole("c2", "<u4").astype("int64")
        order = np.lexsort((second, first, kinds))
        new = np.ones(len(order), dtype=bool)
        new[1:] = np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in (kinds, first, second)])
        which = np.empty(len(order), dtype="int64")
        which[order] = np.cumsum(new) - 1
        one = order[new]
        rare_totals = np.bincount(which, weights=np.concatenate([c[len(k):] for k, c in zip(keys, counts)]), minlength=len(one)).astype("int64")
        asked, rare_asked, back, i, j = totals[inverse].astype("<u4"), rare_totals[which].astype("<u4"), [], 0, 0
        for k, c in zip(keys, counts):
            back.append(_packed(np.concatenate([asked[i:i + len(k)], rare_asked[j:j + len(c) - len(k)]])))
            i, j = i + len(k), j + len(c) - len(k)
        seen, rare_seen = totals > 0, rare_totals > 0
        of_known = rare_seen & (kinds[one] & 1 == 1)
        of_rare = rare_seen & (kinds[one] & 1 == 0)
        plain = distinct[seen].astype("int64")
        p, rare_p = probabilities(by_count[plain % n] if len(plain) else plain, unigrams), probabilities(c2[one], unigrams)
        frames = [pd.DataFrame({"chunk": group["chunk"], "bucket": group["bucket"], "totals": back}),
                  _contexts("w1", np.concatenate([plain // n, first[one][of_known].astype("int64")]),
                            np.concatenate([totals[seen], rare_totals[of_known]]), np.concatenate([p, rare_p[of_known]])),
                  _contexts("h1", first[one][of_rare].view("int64"), rare_totals[of_rare], rare_p[of_rare])]
        ints = ["chunk", "bucket", "w1", "h1", *_STATISTICS[:-1]]
        columns = [x.split()[0] for x in _ANSWER.split(", ")]
        return pd.concat([f.astype({c: "Int64" for c in ints if c in f}).reindex(columns=columns) for f in frames if len(f)],
                         ignore_index=True).astype({c: "Int64" for c in ints})

    return requests.groupBy("bucket").applyInPandas(add, _ANSWER)


def weights(n: np.ndarray, more: np.ndarray, mass: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 of what a discounted count of a context is multiplied with, and of its back-off weight, by context.

    ``n[r - 1]`` are the numbers of words seen r times behind a context, ``more`` the sum of the counts above DISCOUNTED, ``mass``
    the unigram probability of all words seen. At least one part in count + 1 is left to the words not seen.
    """
    r = np.arange(1, DISCOUNTED + 1)[:, None]
    size = (r * n).sum(axis=0) + more
    kept = ((d[1:, None] * r) * n).sum(axis=0) + more
    scale = np.minimum(1.0, size / (size + 1) / (kept / size)) / size
    return np.log10(scale), np.log10((1 - kept * scale) / np.maximum(1 - mass, 1e-12))


def context_weights(w1: np.ndarray, n: np.ndarray, more: np.ndarray, mass: np.ndarray, d: np.ndarray, words: int = KNOWN) -> tuple[np.ndarray, np.ndarray]:
    """``weights`` by number of the context word."""
    factor, back = np.zeros(words), np.zeros(words)  # a context never seen backs off with weight one
    factor[w1], back[w1] = weights(n, more, mass, d)
    return factor, back


def _numbers(x: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return x[_STATISTICS[:DISCOUNTED]].to_numpy("float64").T, x["more"].to_numpy("float64"), x["mass"].to_numpy("float64")


def _rare_weights(answers: DataFrame, d: np.ndarray) -> DataFrame:
    """h1, factor, back of the contexts that are no known words."""
    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            factor, back = weights(*_numbers(x), d)
            yield pd.DataFrame({"h1": x["h1"], "factor": factor, "back": back})

    return _summed(answers, "h1").mapInPandas(weigh, "h1 long, factor double, back double")


def _summed(answers: DataFrame, name: str) -> DataFrame:
    return answers.where(f"{name} is not null").groupBy(name).agg(*[F.sum(x).alias(x) for x in _STATISTICS])


def _scores(chunks: DataFrame, answers: DataFrame, known, buckets: int, model, total: int, distinct_words: int) -> DataFrame:
    """Rows of texts (h1 null) with what the chunk knows of their score, and rows (row, h1, seen, m): m bigrams of the text behind
    the rare word h1, seen or not, that lack the weight of that word."""
    def score(own: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        factor, back, d, unigrams, single = model.value
        x = _Chunk(next(own.itertuples()), known.value, buckets)
        totals = np.empty(len(x.w1), dtype="int64")
        totals[x.order] = np.concatenate([_unpacked(t, "<u4") for t in got.sort_values("bucket")["totals"]])
        seen, c1 = totals > 0, x.counts[x.w1]
        first = np.minimum(x.w1, len(factor) - 1)
        of_known = x.w1 < x.known
        # a rare word met once has one bigram, whatever follows; a word never met backs off with weight one
        weight = np.where(of_known, np.where(seen, factor[first], back[first]), np.where(seen & (c1 == 1), single, 0.0))
        discounted = np.maximum(totals, 1) * np.where(totals <= DISCOUNTED, d[np.minimum(totals, DISCOUNTED)], 1.0)
        each = np.log10(np.where(seen, discounted, probabilities(x.counts[x.w2], unigrams))) + weight
        heads, row = x.heads, own["chunk"].iloc[0] * _TEXTS
        starts = np.cumsum(heads["n"]) - heads["n"]
        c = x.counts[x.ids]
        texts = pd.DataFrame({
            "row": row + np.arange(len(heads)), "doc_id": pd.array(heads["doc_id"].astype("int64"), dtype="Int64"),
            "held_out": heads["held_out"], "n_tokens": heads["n"].astype("int64"), "n_known": np.add.reduceat((c > 0).astype("int64"), starts),
            "base_score": np.add.reduceat(np.log10((c + 1) / (total + distinct_words + 1)), starts), "score": np.add.reduceat(each[x.inverse], starts)}).assign(
                doc_id=lambda t: t["doc_id"].mask(heads["no_id"]))
        late = (~of_known & (c1 > 0) & ~(seen & (c1 == 1)))[x.inverse]
        if not late.any():
            return texts.assign(h1=pd.array([None] * len(texts), dtype="Int64"), seen=None, m=pd.array([None] * len(texts), dtype="Int64"))[_COLUMNS]
        at = x.inverse[late]
        more = pd.DataFrame({"row": row + np.repeat(np.arange(len(heads)), heads["n"])[late], "h1": x.hashes[x.w1[at]].view("int64"), "seen": seen[at]})
        more = more.groupby(["row", "h1", "seen"], as_index=False).size().rename(columns={"size": "m"})
        out = pd.concat([texts.astype({"held_out": "boolean", "n_tokens": "Int64", "n_known": "Int64"}).reindex(columns=_COLUMNS),
                         more.astype({"h1": "Int64", "seen": "boolean", "m": "Int64"}).reindex(columns=_COLUMNS)], ignore_index=True)
        return out.astype({c: "Int64" for c in ("doc_id", "n_tokens", "n_known", "h1", "m")} | {c: "boolean" for c in ("held_out", "seen")})

    schema = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
              "h1 long, seen boolean, m long")
    return chunks.groupBy("chunk").cogroup(
        answers.where("totals is not null").select("chunk", "bucket", "totals").groupBy("chunk")).applyInPandas(score, schema)


_COLUMNS = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "h1", "seen", "m"]


def score_texts(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    context = docs.sparkSession.sparkContext
    inputs = _inputs(docs)
    counts = stage(word_counts(inputs), "katz-words")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    low = {r["c"]: r["count"] for r in counts.where(F.col("c") <= DISCOUNTED + 1).groupBy("c").count().collect()}
    top = counts.orderBy(F.desc("c"), "h").limit(KNOWN).toArrow().to_pandas()  # at most KNOWN rows
    h, c = top["h"].to_numpy("int64").view("uint64"), top["c"].to_numpy("int64")
    order = np.argsort(h)
    known = context.broadcast((h[order], order.astype("uint32"), h, c))
    unigrams = unigram_model(total, low)
    chunks = stage(_chunks(inputs, known), "katz-chunks")
    tokens = chunks.agg(F.coalesce(F.sum(F.length("ids")), F.lit(0))).first()[0] // 4
    buckets = max(1, tokens // CHUNK)
    bare, chunks = chunks, stage(_with_counts(chunks, counts.where(F.col("c") <= int(c[-1]) if len(c) else F.lit(True)), buckets), "katz-chunks")
    drop_stage(bare)
    drop_stage(counts)
    answers = stage(_answers(_requests(chunks, known, buckets), known, unigrams), "katz-bigrams")
    sums = answers.agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in _STATISTICS[:-2]]).first()
    d = good_turing(np.array([0, *sums], dtype=float))
    rows = _summed(answers, "w1").toArrow().to_pandas()  # at most KNOWN rows
    factor, back = context_weights(rows["w1"].to_numpy("int64"), *_numbers(rows), d, max(1, len(h)))
    single = weights(np.array([[1.0], *[[0.0]] * (DISCOUNTED - 1)]), np.zeros(1), np.zeros(1), d)[0][0]
    model = context.broadcast((factor, back, d, unigrams, single))
    scored = _scores(chunks, answers, known, buckets, model, total, distinct)
    if distinct > len(h):
        scored = stage(scored, "katz-scores")
        late = scored.where("h1 is not null").select("row", "h1", "seen", "m").join(_rare_weights(answers, d), "h1")
        gained = late.groupBy("row").agg(F.sum(F.col("m") * F.when(F.col("seen"), F.col("factor")).otherwise(F.col("back"))).alias("gained"))
        scored = scored.where("h1 is null").join(gained, "row", "left").withColumn("score", F.col("score") + F.coalesce("gained", F.lit(0.0)))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known",
                         F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")
