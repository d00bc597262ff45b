"""SentencePiece encoding and decoding with an Aho-Corasick automaton over the pieces.

One pass over a text follows the automaton; at every position its output links name all pieces that end there, longest
first, and each relaxes the best score of that position (Viterbi). Characters no piece covers become byte pieces. No
piece holds a word mark behind another character, so texts are cut in front of word marks without changing the result, and
the cuts are looked up in a bounded cache. The model is read on the driver from ``model``, a path given by the caller, and
its list of pieces (a fixed vocabulary) is broadcast.

Edge cases: null or empty text has no pieces and decodes to the empty text; a literal word mark in a text becomes byte
pieces, so that decoding gives every text back exactly; of segmentations with equal scores the one whose last pieces are
longest wins; repeated rows are encoded each; other columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Where the public vocabulary lies unless the caller says otherwise; score of unknown characters below the least.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN = 10.0


def load_pieces(model: str = MODEL) -> tuple[list[tuple[str, float, int]], list[int], int]:
    """(piece, score, id) of the ordinary pieces, ids of the 256 byte pieces, number of ids."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    plain, by_byte = [], {}
    for i in range(len(sp)):
        if sp.is_byte(i):
            by_byte[int(sp.id_to_piece(i)[1:-1], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            plain.append((sp.id_to_piece(i), sp.get_score(i), i))
    if len(by_byte) != 256:
        raise ValueError(f"{model} has no byte pieces")
    return plain, [by_byte[b] for b in range(256)], len(sp)


class Encoder(dict):
    """Maps a cut of a text (spaces as word marks) to the packed ids of its pieces; holds at most ``bound`` cuts."""

    def __init__(self, plain, by_byte, size, bound: int = 400_000):
        super().__init__()
        self.bound, self.by_byte = bound, by_byte
        self.automaton = ahocorasick.Automaton()
        for piece, score, i in plain:
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score, _ in plain) - UNKNOWN
        inside = {c for piece, _, _ in plain if len(piece) > 1 for c in piece}
        late = any(MARK in piece.lstrip(MARK) for piece, _, _ in plain)
        lone = "\n" if "\n" not in inside else ""
        # cuts: a run of word marks with what follows it, or a character that is part of no longer piece
        self.cuts = re.compile(r"[\s\S]+" if late else rf"[{lone}\0]|{MARK}*[^{MARK}{lone}\0]+|{MARK}+")
        self.bytes = [b""] * size
        for piece, _, i in plain:
            self.bytes[i] = piece.replace(MARK, " ").encode()
        for b, i in enumerate(by_byte):
            self.bytes[i] = bytes([b])

    def best(self, cut: str) -> tuple[list[int], float]:
        """Ids and score of the best segmentation of ``cut``."""
        n = len(cut)
        score, back = [0.0] + [None] * n, [None] * (n + 1)
        matches = self.automaton.iter(cut)
        end, found = next(matches, (n, None))
        for at in range(n):
            top, link = score[at] + self.unknown, None
            while end == at:
                length, gain, i = found
                total = score[at + 1 - length] + gain
                if total > top or link is None and total == top:
                    top, link = total, (length, i)
                end, found = next(matches, (n, None))
            score[at + 1], back[at + 1] = top, link
        ids, at = [], n
        while at:
            if back[at] is None:
                ids += [self.by_byte[b] for b in reversed(cut[at - 1].encode("utf-8", "replace"))]
                at -= 1
            else:
                ids.append(back[at][1])
                at -= back[at][0]
        return ids[::-1], score[n]

    def __missing__(self, cut: str) -> bytes:
        if len(self) >= self.bound:
            self.clear()
        packed = np.array(self.best(cut)[0], dtype="<i4").tobytes()
        if len(cut) <= 64:
            self[cut] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Packed ids of ``text``."""
        if not text:
            return b""
        parts, out = text.split(MARK), []
        for k, part in enumerate(parts):
            if k:
                out += [np.array([self.by_byte[b] for b in MARK.encode()], dtype="<i4").tobytes()]
            marked = (MARK if k == 0 else "") + part.replace(" ", MARK)
            out += map(self.__getitem__, self.cuts.findall(marked))
        return b"".join(out)

    def decode(self, ids) -> str:
        """The text whose pieces are ``ids``, without the space that encoding puts in front."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")[1:]


_ENCODERS: dict = {}


def _encoder(shared) -> Encoder:
    """One for each worker process and vocabulary."""
    if shared.id not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[shared.id] = Encoder(*shared.value)
    return _ENCODERS[shared.id]


class _Shared:
    """A broadcast with an id that survives pickling."""

    def __init__(self, broadcast, name: str):
        self.broadcast, self.id = broadcast, name

    @property
    def value(self):
        return self.broadcast.value


def encode_pieces(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, ids, n_pieces, and exact: whether decoding the ids gives the text again."""
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(load_pieces(model)), model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            packed, exact = [], []
            for text in batch.column("text").to_pylist():
                ids = encoder.encode(text)
                packed.append(ids)
                exact.append(encoder.decode(np.frombuffer(ids, dtype="<i4").tolist()) == text)
            sizes = np.fromiter((len(p) // 4 for p in packed), dtype="int64", count=len(packed))
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype("int32")
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), dtype="<i4")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(sizes), pa.array(exact, pa.bool_())],
                                             names=["doc_id", "ids", "n_pieces", "exact"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids array<int>, n_pieces long, exact boolean")


def decode_pieces(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, text from doc_id, ids."""
    shared = _Shared(encoded.sparkSession.sparkContext.broadcast(load_pieces(model)), model)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            texts = [encoder.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(decode, "doc_id long, text string")
